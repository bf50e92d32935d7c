"""Operators for training data: text, tokens, vectors and conversations. Nothing else imports this."""
