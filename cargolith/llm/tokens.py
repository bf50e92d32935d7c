"""Whole texts to token ids through a table of distinct pieces (shared by operators 2, 6 and 10).

Texts are cut at white space, where every tokenizer used here starts a new word; each distinct piece is
encoded once and kept while the Python worker lives. The table is emptied at ``LIMIT`` pieces, so that memory
is bounded whatever the vocabulary of the corpus; results do not depend on that.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa

#: Distinct pieces kept, and bytes of a batch of texts that are encoded together.
LIMIT = 300_000
BATCH = 2 << 20
#: White space by the Unicode property (fixed values).
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_UNUSUAL = re.compile(f"[\x00\x1c-\x1f{SPACE.replace(' ', '').replace(chr(10), '')}]")
_PIECE = re.compile(f"[{SPACE}]+(?![^{SPACE}])|[{SPACE}]?[^{SPACE}]+")
_WORD = re.compile(f"[^{SPACE}]+")
#: The rule of a tokenizer that lower-cases and cuts words into runs of letters, single digits and other runs (fixed value).
RUN_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters and digits up to U+00FF (fixed values); no normal form changes these characters.
_LETTER, _DIGIT = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"
_RUN = re.compile(f"[{_LETTER}]+|[{_DIGIT}]| |[^{_LETTER}{_DIGIT} ]+")
#: RUN_RULE for whole lower-cased texts of characters up to U+00FF.
_TEXT_RUN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_LETTER}{_DIGIT}{SPACE}]+")


def spaced_pieces(text: str) -> list[str]:
    """Keys of a text for tokenizers that join a blank to the word after it.

    A key without NUL at its start stands for a blank and itself, one with NUL for what follows the NUL.
    """
    if not text:
        return []
    plain = not (text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or _UNUSUAL.search(text))
    if plain:
        out = []
        for line in text.split("\n"):
            parts = line.split(" ")
            parts[0] = "\0" + parts[0]
            if out:
                out.append("\0\n")
            out += parts
        return out
    return [m[1:] if m[0] == " " and len(m) > 1 and m[1] not in "\0 " else "\0" + m for m in _PIECE.findall(text)]


def piece_text(key: str) -> str:
    return key[1:] if key[:1] == "\0" else " " + key


def plain_words(text: str) -> list[str]:
    """Words of a text for tokenizers that drop white space."""
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return _WORD.findall(text)
    return text.split()


def lower_runs(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The runs that RUN_RULE cuts words of characters up to U+00FF without apostrophe and white space into,
    lower-cased, and how many each word has."""
    found = _RUN.findall(" ".join(words).lower())
    gaps = [i for i, r in enumerate(found) if r == " "]
    ends = np.array([*gaps, len(found)])
    return [r for r in found if r != " "], np.diff(ends, prepend=-1) - 1


def reordered(ids: np.ndarray, counts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``ids`` (``counts`` of each) with run k at place ``order[k]``, and the counts there."""
    place = np.argsort(order)
    starts = (np.cumsum(counts) - counts)[place]
    counts = counts[place]
    at = np.cumsum(counts) - counts
    return ids[np.arange(counts.sum()) + np.repeat(starts - at, counts)], counts


class PieceTable(dict):
    """Numbers pieces in order of appearance, and holds each one's ids after ``settle``."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = LIMIT):
        """``encode`` gives all ids of a list of pieces in one run, and how many each has."""
        super().__init__()
        self.encode = encode
        self.limit = limit
        self.runs: PieceTable | None = None
        self.new: list[str] = []
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)

    def __missing__(self, key: str) -> int:
        self[key] = at = len(self)
        self.new.append(key)
        return at

    def settle(self) -> None:
        if not self.new:
            return
        ids, counts = self.encode(self.new)
        done = len(self) - len(self.new)
        used = int(self.ends[done - 1]) if done else 0
        while len(self.ids) < used + len(ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while len(self.ends) < len(self):
            self.ends = np.concatenate((self.ends, np.zeros_like(self.ends)))
        self.ids[used : used + len(ids)] = ids
        self.ends[done : len(self)] = used + np.cumsum(counts)
        self.new = []

    def batch(self, texts: list[str], pieces: Callable[[str], list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one run, and where each text's ids start (one more entry than texts)."""
        if len(self) > self.limit:
            self.clear()
        at, counts = array("i"), []
        number = self.__getitem__
        for t in texts:
            own = pieces(t)
            counts.append(len(own))
            at.extend(map(number, own))
        return self._spread(at, counts)

    def lists(self, pieces: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """As ``batch`` for the pieces of all texts; only distinct ones are looked up."""
        if len(self) > self.limit:
            self.clear()
        coded = pa.array(chain.from_iterable(pieces), pa.string()).dictionary_encode()
        number = np.fromiter(map(self.__getitem__, coded.dictionary.to_pylist()), np.int32, len(coded.dictionary))
        return self._spread(number[coded.indices.to_numpy()], [len(p) for p in pieces])

    def parts(self, pieces: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``batch`` for texts that are cut already: all their pieces in one list, and how many each has."""
        if len(self) > self.limit:
            self.clear()
        return self._spread(array("i", map(self.__getitem__, pieces)), counts)

    def _spread(self, at: array | np.ndarray, counts: list[int] | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.settle()
        at = np.frombuffer(at, np.int32) if len(at) else np.zeros(0, np.int32)
        ends = self.ends[at]
        starts = np.where(at > 0, self.ends[at - 1], 0)
        sizes = ends - starts
        total = np.concatenate(([0], np.cumsum(sizes)))
        where = np.arange(total[-1]) + np.repeat(starts - total[:-1], sizes)
        return self.ids[where], total[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]


def text_batches(texts: list[str | None], limit: int = BATCH):
    """(first, end) of runs of texts of about ``limit`` characters; a longer one stands alone."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield i, j + 1
            i, size = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


_TABLES: dict[tuple, PieceTable] = {}
#: Words of byte-level vocabularies: contractions, then runs of letters, of digits, of other marks, and white space (fixed value).
BYTE_RULE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in such vocabularies: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def byte_ranks(path: str) -> dict[bytes, int] | None:
    """Token bytes and ids of a byte-level file whose ids follow the order of its merges, else None.

    For those tiktoken gives the ids that the tokenizers library gives, in a third of its time.
    """
    with open(path, encoding="utf-8") as f:
        parts = json.load(f)
    model, cut = parts["model"], parts["pre_tokenizer"] or {}
    if parts["normalizer"] or model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    vocabulary, letters = model["vocab"], _byte_letters()
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [vocabulary.get("".join(m), -1) for m in merges]
    added = {t["content"] for t in parts["added_tokens"]}
    if ids != sorted(set(ids)) or (ids and ids[0] < 0):
        return None
    out = {bytes(letters[c] for c in token): number for token, number in vocabulary.items() if token not in added}
    return out if len(out) == len(letters) + len(merges) else None


def _cuts_runs(tokenizer) -> bool:
    """Whether the tokenizer works by RUN_RULE on lower-cased text and marks the last token of each run."""
    parts = json.loads(tokenizer.to_str())
    steps = [x["type"] for x in (parts["normalizer"] or {}).get("normalizers", [])]
    rules = [x.get("pattern", {}).get("Regex") for x in (parts["pre_tokenizer"] or {}).get("pretokenizers", [])]
    return steps == ["NFC", "Replace", "Lowercase"] and rules == [RUN_RULE, None] and bool(parts["model"].get("end_of_word_suffix"))


def _run_table(tokenizer) -> PieceTable:
    """Ids of lower-cased runs. Many go through the library at a time, a blank between them; the suffix of a
    run's last token tells them apart."""
    suffix = tokenizer.model.end_of_word_suffix
    closes = np.zeros(tokenizer.get_vocab_size(), bool)
    closes[[number for token, number in tokenizer.get_vocab().items() if token.endswith(suffix)]] = True

    def encode(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        runs, counts = [], []
        for lo in range(0, len(keys), 1000):
            part = keys[lo : lo + 1000]
            ids = np.array(tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            last = np.flatnonzero(closes[ids])
            if len(last) != len(part):
                raise RuntimeError("last tokens and runs do not add up")
            runs.append(ids)
            counts.append(np.diff(last, prepend=-1))
        return np.concatenate(runs), np.concatenate(counts)

    return PieceTable(encode, 2 * LIMIT)


def library_table(path: str, spaced: bool) -> PieceTable:
    """The worker's table for a file of the tokenizers library.

    Pieces go through the library many at a time, joined by a mark that has a token of its own (line feed, or
    NUL where white space is dropped); pieces in which the mark occurs go alone. Where the tokenizer cuts words
    into runs, a second table holds the runs of plain words, which are far fewer than the words.
    """
    key = (path, spaced)
    if key not in _TABLES:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        mark = "\n" if spaced else "\0"
        own = tokenizer.encode(mark, add_special_tokens=False).ids
        if len(own) != 1:
            raise ValueError(f"{path}: the mark between pieces is not one token")
        parts_of_words = _run_table(tokenizer) if not spaced and _cuts_runs(tokenizer) else None

        def encode(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
            runs, counts, order = [], [], []
            rest = range(len(keys))
            if parts_of_words is not None:
                plain = [i for i, k in enumerate(keys) if "'" not in k and (k.isascii() or max(k) <= "\xff")]
                flat, starts = parts_of_words.parts(*lower_runs([keys[i] for i in plain])) if plain else (np.zeros(0, np.uint32), np.zeros(1, np.int64))
                runs.append(flat)
                counts.append(np.diff(starts))
                order += plain
                done = set(plain)
                rest = [i for i in rest if i not in done]
            texts = {i: piece_text(keys[i]) if spaced else keys[i] for i in rest}
            joinable = [i for i, t in texts.items() if mark not in t and (not spaced or not t[-1:].isspace())]
            for lo in range(0, len(joinable), 1000):
                part = joinable[lo : lo + 1000]
                joined = mark.join([texts[i] for i in part]) if spaced else f" {mark} ".join([texts[i] for i in part])
                ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
                marks = np.flatnonzero(ids == own[0])
                if len(marks) != len(part) - 1:
                    raise RuntimeError("marks between pieces do not add up")
                counts.append(np.diff(np.concatenate(([-1], marks, [len(ids)]))) - 1)
                runs.append(np.delete(ids, marks))
            together = set(joinable)
            alone = [i for i in texts if i not in together]
            for i in alone:
                runs.append(np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32))
                counts.append(np.array([len(runs[-1])]))
            order += joinable + alone
            return reordered(np.concatenate(runs), np.concatenate(counts), np.array(order))

        _TABLES[key] = PieceTable(encode)
        _TABLES[key].runs = parts_of_words
    return _TABLES[key]


def encode_words(table: PieceTable, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts by a ``library_table`` that drops white space, and where each text's ids start (one more entry).

    Where the tokenizer cuts words into runs, texts of characters up to U+00FF are cut into runs as a whole.
    """
    if table.runs is None:
        return table.batch(texts, plain_words)
    narrow = np.array([t.isascii() or max(t) <= "\xff" for t in texts], bool)
    flat, starts = table.runs.lists([_TEXT_RUN.findall(t.lower()) for t, n in zip(texts, narrow, strict=True) if n])
    if narrow.all():
        return flat, starts
    rest, more = table.batch([t for t, n in zip(texts, narrow, strict=True) if not n], plain_words)
    order = np.concatenate((np.flatnonzero(narrow), np.flatnonzero(~narrow)))
    ids, counts = reordered(np.concatenate((flat, rest)), np.concatenate((np.diff(starts), np.diff(more))), order)
    return ids, np.concatenate(([0], np.cumsum(counts)))


#: Characters of a text encoded at once; a longer text is cut before single blanks between words.
CHUNK = 1 << 16
_GAP = re.compile(r"(?<=\S) (?=\S)")
_CODERS: dict[str, Callable] = {}


def _chunks(text: str, limit: int):
    """Parts of a text that every rule here cuts at: before a blank with no white space beside it."""
    at = 0
    while len(text) - at > limit:
        gap = _GAP.search(text, at + limit)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:] if at else text


def byte_coder(path: str) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """The worker's function from texts to all ids in one run and where each text's ids start (one more entry).

    Byte-level files with ids in the order of their merges go through tiktoken, whole texts at a time; others
    through ``library_table``.
    """
    if path not in _CODERS:
        ranks = byte_ranks(path)
        if ranks is None:
            table = library_table(path, True)
            _CODERS[path] = lambda texts: table.batch(texts, spaced_pieces)
        else:
            import tiktoken

            coder = tiktoken.Encoding(path, pat_str=BYTE_RULE, mergeable_ranks=ranks, special_tokens={})

            def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
                runs, starts = [np.zeros(0, np.uint32)], [0]
                for t in texts:
                    own = [np.array(coder.encode_ordinary(c), np.uint32) for c in _chunks(t, CHUNK)]
                    runs += own
                    starts.append(starts[-1] + sum(map(len, own)))
                return np.concatenate(runs), np.array(starts)

            _CODERS[path] = encode
    return _CODERS[path]
