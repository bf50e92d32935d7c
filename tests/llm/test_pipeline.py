"""The pipeline's stages, each against what its input demands."""

import re
import zlib
from collections import Counter

import corpus_pipeline as pipeline
import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cargolith.llm import personal, quality
from cargolith.llm.common import read_table, stash
from test_neardup import brute

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_keep_their_promises(spark, folder):
    docs = read_table(spark, folder, "documents")
    inputs = {}
    for name, stage in pipeline.STAGES:
        inputs[name] = {r.doc_id: r.text for r in docs.collect()}
        columns = docs.columns
        docs = stash(stage(spark, docs, folder), name)
        if name != "packing":
            assert docs.columns == columns
        inputs[name, "out"] = docs.collect()
    network = quality.train(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    scores = quality.scored(read_table(spark, folder, "documents"), network).collect()
    assert {r.doc_id for r in scores if r.score >= 0.5} == {*inputs["near_duplicates"]}
    roots = brute(list(inputs["near_duplicates"].items()), 5, 80)
    assert {d for d, (_, root) in roots.items() if d == root} == {*inputs["substring_dedup"]}
    assert {*inputs["personal_data"]} == {*inputs["substring_dedup"]} == {*inputs["packing"]}
    assert all(inputs["packing"][d] == personal.redact(t) for d, t in inputs["personal_data"].items())
    assert all(r.n_chars == len(r.text) for r in inputs["personal_data", "out"])
    assert {r.doc_id for r in docs.collect()} == {*inputs["packing"]}
    # No passage of 50 words is left twice, what is left stood in the text before, and clean texts are untouched.
    seen, cut = set(), 0
    for d, text in inputs["personal_data"].items():
        before, after = WORD.findall((inputs["substring_dedup"][d] or "").lower()), WORD.findall((text or "").lower())
        rest = iter(before)
        assert all(w in rest for w in after)
        cut += before != after
        own = [" ".join(after[i : i + 50]) for i in range(len(after) - 49)]
        assert len(own) == len(set(own)) and seen.isdisjoint(own)
        seen.update(own)
    every = Counter(" ".join(w[i : i + 50]) for w in (WORD.findall((t or "").lower()) for t in inputs["substring_dedup"].values()) for i in range(len(w) - 49))
    assert (cut > 0) == (max(every.values(), default=0) > 1)
    # Pieces hold the library's ids, and sequences are full and gapless.
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    sequences = {}
    for r in docs.collect():
        ids = [*library.encode(inputs["packing"][r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 1024


def test_stages_take_clashing_columns(spark, folder):
    """Extra columns with the names that stages use inside come through unchanged."""
    few = read_table(spark, folder, "documents").filter("doc_id < 60")
    extra = {"score": F.lit("s"), "_id": F.lit(7), "_TEXT": F.lit("t"), "cuts": F.lit(1), "kept": F.lit(2), "component_id": F.lit(3)}
    docs = stash(few.withColumns(extra), "clash")
    plain = stash(few, "plain")
    for name, stage in pipeline.STAGES:
        docs, plain = (stash(stage(spark, x, folder), name) for x in (docs, plain))
        shared = [c for c in plain.columns if c != "sequence_id"]
        assert sorted(map(str, docs.select(*shared).collect())) == sorted(map(str, plain.select(*shared).collect()))
        if name != "packing":
            assert {tuple(r) for r in docs.select(*extra).distinct().collect()} <= {("s", 7, "t", 1, 2, 3)}
