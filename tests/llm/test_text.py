"""Text operators: tokens, packing, files, personal data, quality and conversations."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex

from cargolith.llm import bpe, chat, idfiles, packing, personal, quality, tokens
from cargolith.session import scratch_path

TEXTS = [None, "", " ", "a", "  a\n\n b", "\tx y ", "é\x85 q\x1cz \0 b", "'re it's 12ab  \n  c　d ", "a\n b", "<|endoftext|> x", "x" * 300,
         "The quick brown fox, jumps over 12345 dogs. " * 400, "日本語 テキスト 🙂", "a", "a"]
SCHEMA = "doc_id long, text string, length long, ids string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i if i != 13 else 3, t, 0, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", 0, None)], SCHEMA)


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(P.path(name)))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


def test_bpe_equals_the_library_and_round_trips(docs):
    import tiktoken

    path = str(P.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    rows = bpe.decode(bpe.encode(docs, path, P.PATTERN), path, P.PATTERN).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        assert r.token_ids == own.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    for r in bpe.digests(docs, path, P.PATTERN).collect():
        if r.doc_id is not None and r.doc_id != 3:
            ids = own.encode_ordinary(TEXTS[r.doc_id] or "")
            assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
            assert r.decoded_sha256 == hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()
    assert bpe.digests(docs.limit(0), path, P.PATTERN).count() == 0


def test_packing_covers_every_token_once(docs):
    encode = library("byte_bpe_50k.json")
    rows = packing.packed(docs, str(P.path("byte_bpe_50k.json"))).collect()
    by, sequences = {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, own in by.items():
        if d in (None, 3):
            continue
        ids, own = encode(TEXTS[d]), sorted(own, key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(ids) and all(r.length == 1024 for r in own[1:])
        for r in own:
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 1024
    assert packing.packed(docs.limit(0), str(P.path("byte_bpe_50k.json"))).count() == 0


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(0)
    for high in (300, 1024):
        h = np.bincount(rng.integers(1, high, 30000), minlength=1025)[1:]
        chosen = packing.plan(h, 1024)
        assert (sum(c * n for c, n in chosen) == h).all()
        assert sum(n for _, n in chosen) <= 1.005 * (h * np.arange(1, 1025)).sum() / 1024 + 1


def test_id_files_read_back_and_by_document(spark, docs):
    encode, path = library("word_bpe_49k.json"), str(P.path("word_bpe_49k.json"))
    manifest = idfiles.write_ids(docs, path, scratch_path(spark, "ids"))
    rows = sorted(idfiles.read_ids(manifest).collect(), key=lambda r: r.start)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    assert rows[0].doc_id is None and [r.doc_id for r in rows[1:]] == sorted(r.doc_id for r in rows[1:])
    for r in rows:
        if r.doc_id not in (None, 3):
            assert np.frombuffer(r.ids, "<u4").tolist() == encode(TEXTS[r.doc_id])
    assert [r.doc_id for r in idfiles.read_ids(manifest, [11]).collect()] == [11]
    files, inner = idfiles._files(manifest.first().file)
    raw = bytearray(files.open_input_file(inner).read())
    raw[8] ^= 255
    with files.open_output_stream(inner + ".bad") as out:
        out.write(bytes(raw))
    with pytest.raises(Exception):  # noqa: B017 - damaged data or a failed checksum
        reader = idfiles.Reader(files.open_input_file(inner + ".bad"))
        reader.frame(0)
    assert idfiles.round_trip(docs.limit(0), path).count() == 0


PII = ["mail a.b+c@x-y.co.uk, or a@b@c.de; x@y", "ip 1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.255", "card 4495 1148-2761 2972 and 4495114827612973",
       "call +1 (454) 555-9913 or +49 30 1", "iban DE89 3704 0044 0532 0130 00 here", "é +1 (454) 555-9913", "ssn 123-45-6789 but 123-45-6789", "9" * 5000 + ".1.1.1"]


def test_personal_data_matches_the_patterns(spark):
    for t in PII + [" ".join(PII)]:
        spans = personal.find_spans(t)
        for kind in personal.BASE:
            want = [m.span() for m in re.finditer(personal.PATTERNS[kind], t) if personal.valid(kind, m[0])]
            assert [(s, e) for k, s, e, _ in spans if k == kind] == want, (kind, t)
    assert {k for t in PII for k, *_ in personal.find_spans(t)} == {*personal.KINDS}
    assert "@" not in personal.redact("write to me@here.org now") and personal.redact(None) is None
    df = spark.createDataFrame([(1, PII[0]), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in personal.digests(df).collect()}
    assert got[1].n_email == 2 and got[2].spans == "" and got[3].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_quality_learns_and_covers_odd_texts(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join("".join(rng.choice(list("abcdefgh"), 5)) + ("&&&" if i % 4 == 0 else "") for _ in range(60))) for i in range(600)]
    docs = spark.createDataFrame([*rows, (-1, None), (-2, ""), (-3, "ab"), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i, _ in rows] + [(5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 604 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id >= 0]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert np.mean([r.predicted == (r.doc_id % 4 != 0) for r in held]) > 0.95
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def test_conversations_read_back(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [(1, k, r, t) for k, (r, t) in enumerate([("system", "be: kind"), ("user", said), ("assistant", said), ("user", None), ("assistant", "b\\")] * 6)]
    rows += [(2, k, "user" if k % 2 else "assistant", f"w{k} " * (k % 7 * 40)) for k in range(300)]
    rows += [(None, None, None, None), (3, 0, "assistant", "x " * 3000), (4, 1, "a", "p"), (4, 1, "a", "p")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.formatted(df).collect()}
    for conv in {r[0] for r in rows}:
        own = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        loss = "".join(t for r, t in own if r == "assistant")
        g = got[conv]
        assert (g.n_turns, g.loss_chars) == (len(own), len(loss))
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    for w in chat.windows(df).collect():
        assert w.n_new == 1 or chat.count_tokens(w.text) <= chat.BUDGET
    assert chat.formatted(df.limit(0)).count() == 0


def best_fit_sequences(h, capacity):
    return sum(n for _, n in packing._best_fit(h, capacity))


@pytest.mark.parametrize("lengths,times,most", [((300, 350, 370), 1000, 1000), ((600, 424), 500, 500), ((513,), 7, 7), ((1024,), 3, 3), ((1,), 2000, 2)])
def test_program_finds_the_configurations(lengths, times, most):
    h = np.zeros(1024, np.int64)
    h[np.array(lengths) - 1] = times
    use = packing.fractional(h, 1024)
    cover = np.zeros(1024)
    for config, x in use.items():
        assert sum(config) <= 1024
        np.add.at(cover, np.array(config) - 1, x)
    assert (cover[h > 0] >= h[h > 0] - 1e-6).all()
    assert sum(n for _, n in packing.plan(h, 1024)) == most


@pytest.mark.parametrize("seed,n", [(0, 40), (1, 300), (2, 4000)])
def test_plan_needs_no_more_than_best_fit(seed, n):
    h = np.bincount(np.random.default_rng(seed).integers(0, 200, n), minlength=200)
    chosen = packing.plan(h, 200)
    assert (sum(counts * times for counts, times in chosen) == h).all()
    assert all((np.arange(1, 201) * counts).sum() <= 200 for counts, _ in chosen)
    assert sum(times for _, times in chosen) <= best_fit_sequences(h, 200)


def test_byte_coder_gives_the_ids_of_the_library(docs, monkeypatch):
    """Whole texts, special strings, white space of all kinds, and texts cut into parts."""
    from tokenizers import Tokenizer

    path = str(P.path("byte_bpe_50k.json"))
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = [r.text or "" for r in docs.collect()]
    texts += ["<|endoftext|> a", "", " ", "\n\n a  b\t c \x85\xa0d  ", "it's  we'LL 12 345½ x²", "日本 語  、", "a\x1c b  c", "ab" * 4000, "  " * 300 + "x", "é ퟿ \U0001f600 ok"]
    for size in (tokens.CHUNK, 7):
        monkeypatch.setattr(tokens, "CHUNK", size)
        flat, starts = tokens.byte_coder(path)(texts)
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [flat[a:b].tolist() for a, b in zip(starts, starts[1:])] == want


def test_only_plain_byte_level_files_take_the_short_way():
    assert tokens.byte_ranks(str(P.path("word_bpe_49k.json"))) is None
    assert len(tokens.byte_ranks(str(P.path("byte_bpe_50k.json")))) == 50_256


def test_a_word_goes_through_the_queries_once():
    own = bpe.Codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    seen, words = [], own._words
    own._words = lambda found: (seen.extend(found), words(found))[1]
    a, _ = own.encode(["zyxwvut, (zyxwvut) zyxwvut"])
    b, _ = own.encode(["zyxwvut! qq-zyxwvut"])
    assert len(seen) == len(set(seen)) and "zyxwvut" in seen
    assert b"".join(own.decode(np.concatenate((a, b)), np.array([0, len(a) + len(b)]))) == b"zyxwvut, (zyxwvut) zyxwvutzyxwvut! qq-zyxwvut"


def test_runs_of_many_words_at_once():
    words = ["Ab12ab!!,,x", "É½b", "...", "a", "1", "ß²-³ª"]
    runs, counts = tokens.lower_runs(words)
    assert counts.tolist() == [len(regex.findall(tokens.RUN_RULE, w.lower())) for w in words]
    assert runs == [r for w in words for r in regex.findall(tokens.RUN_RULE, w.lower())]


def test_long_and_marked_words_merge_as_in_the_library():
    """Chains of merges at both ends of a word, repeated pairs, and a word of one token beside words of many."""
    import tiktoken

    path = str(P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    rng = np.random.default_rng(3)
    texts = ["aaaaaaa" * 9, " the", "ééé\x00\x01 ß", "internationalisation internationalisations", "ananananas banana" * 3]
    texts += ["".join(rng.choice(list("etaoins htr'"), 200)) for _ in range(40)]
    own = bpe.Codec(path, P.PATTERN)
    flat, starts = own.encode(texts)
    assert [flat[a:b].tolist() for a, b in zip(starts, starts[1:])] == [library.encode_ordinary(t) for t in texts]
    assert [x.decode() for x in own.decode(flat, starts)] == texts
    # Rows of a step are linked: no window, hence no sort of all letters in each step.
    assert "over (" not in bpe.ENCODE.lower()


def test_whole_texts_are_cut_into_runs():
    """Texts up to U+00FF go to the runs as a whole, contractions and odd white space included; others by words."""
    encode, path = library("word_bpe_49k.json"), str(P.path("word_bpe_49k.json"))
    texts = ["don't we'LL it's 'tis ''s !'s 's's a'b", "", "É½b\xa0x\x85y\x0bz\x1cq \0 r\0s", "日本 don't’s", " \n", "Ab12ab!!,,x ß²-³ª", "　a b", "'"]
    table = tokens.library_table(path, False)
    for size in (len(texts), 1):
        for lo in range(0, len(texts), size):
            flat, starts = tokens.encode_words(table, texts[lo : lo + size])
            assert [flat[a:b].tolist() for a, b in zip(starts, starts[1:])] == [encode(t)[:-1] for t in texts[lo : lo + size]]
    before = len(table)
    tokens.encode_words(table, ["zqxj'wvut's 12zqxj"])
    assert len(table) == before and "zqxj" in table.runs
