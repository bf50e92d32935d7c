"""Repeated passages by paragraph MinHash banding (operator 1).

A paragraph is a run of ``PARAGRAPH`` words; one starts at every word, so that a passage is seen wherever it
stands in a text. A band is one minimum hash over a paragraph's five-word shingles. Neighbouring paragraphs
mostly share their minimum, so that a text needs about 2 / (PARAGRAPH - SIZE + 2) keys per word and band.
Two paragraphs of similarity s share a band with a probability of 1 - (1 - s) ** BANDS; a repeated passage of
50 words holds some twenty equal paragraphs, hence meets in any case.

Each text meets the first text of each of its keys, if they also agree ``APART`` words before or after the
shared shingle, as two texts with ``min_words`` equal words around it must. Where a place of a key
has no confirmed passage around it (a short common line, say; also if its first place is in the same text),
all places of the key go on to a second round, under keys that leave nothing to chance: all runs of ``min_words - SIZE`` words around
the shared shingle, in steps of SIZE. Texts that share ``min_words`` equal words share such a run, and those
with such a run in common confirm each other, hence no third round and no comparison of all with all.

A meeting is confirmed on both full texts: aligned at the shared shingle, all runs of words are taken in
which the five-word shingles of both sides have a Jaccard similarity of ``SIMILARITY`` or more; they count
from ``min_words - SIZE`` words on (every repeat of ``min_words`` is found). Overlapping passages of a
text form a region; regions linked by meetings form a cluster by components. All but the first occurrence
(in order of doc_id, then place) are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cargolith.llm.common import _STEP, components, free_name, like, mix, shingles, stash, text_slices, words

SIZE = 5
PARAGRAPH = 32
BANDS = 2
APART = 18
SIMILARITY = 0.8
MIN_WORDS = 50


def _narrow(docs: DataFrame) -> DataFrame:
    return like(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def paragraph_keys(docs: DataFrame) -> DataFrame:
    """(key, doc_id, at, around): the minimum shingle of each paragraph and band, and the word it starts at.

    ``around`` holds 16 bits of the shingles APART words before (high) and after (low); 0 stands for none there.
    """
    salts = mix(np.arange(11, 11 + BANDS, dtype=np.uint64))
    span = PARAGRAPH - SIZE + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for i, j, data, offs in text_slices(batch.column("text")):
                hashes, _, _, first = words(data, offs)
                n = len(hashes)
                if n < PARAGRAPH:
                    continue
                runs = np.zeros(n - SIZE + 1, np.uint64)
                for k in range(SIZE):
                    runs += mix(hashes[k : n - SIZE + 1 + k] + np.uint64(k))
                of = np.repeat(np.arange(j - i), np.diff(first))
                begin = np.arange(n - PARAGRAPH + 1)
                begin = begin[of[begin] == of[begin + PARAGRAPH - 1]]
                if not len(begin):
                    continue
                spots, keys = [], []
                for salt in salts:
                    value = mix(runs ^ salt)
                    # Minimum over each paragraph by doubling; then its first place in the paragraph.
                    low, width = value, 1
                    while width * 2 <= span:
                        low = np.minimum(low[: len(low) - width], low[width:])
                        width *= 2
                    low = np.minimum(low[begin], low[begin + span - width])
                    order = np.flatnonzero(np.concatenate(([True], (low[1:] != low[:-1]) | (begin[1:] != begin[:-1] + 1))))
                    low, start = low[order], begin[order]
                    place = start.copy()
                    wait = np.ones(len(start), bool)
                    for k in range(span):
                        hit = wait & (value[start + k] == low)
                        place[hit] = start[hit] + k
                        wait &= ~hit
                    spots.append(place)
                    keys.append(low)
                spot, key = np.concatenate(spots), np.concatenate(keys)
                # Of places less than a paragraph apart with the same key (periodic text) the first stands for all.
                order = np.lexsort((spot, key))
                spot, key = spot[order], key[order]
                text = of[spot]
                lead = np.ones(len(spot), bool)
                lead[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1]) | (spot[1:] - spot[:-1] >= span)
                spot, key, text = spot[lead], key[lead], text[lead]
                short = (mix(runs) >> np.uint64(48)) | np.uint64(1)
                back = np.where(spot - APART >= first[text], short[np.maximum(spot - APART, 0)], np.uint64(0))
                ahead = np.where(spot + APART + SIZE <= first[text + 1], short[np.minimum(spot + APART, len(short) - 1)], np.uint64(0))
                around = ((back << np.uint64(16)) | ahead).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(ids[i + text].astype(np.int64)), pa.array((spot - first[text]).astype(np.int32)), pa.array(around)],
                    ["key", "doc_id", "at", "around"])

    return docs.filter("doc_id is not null").mapInArrow(run, "key long, doc_id long, at int, around int")


def _runs(same: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Word runs [start, end) of an alignment; ``same`` marks equal shingles.

    Every run of ``min_words`` with the similarity is in one of them; those that overlap are joined.
    """
    at = np.flatnonzero(same)
    if not len(at):
        return []
    # A changed word breaks SIZE shingles; runs on both sides of a few changed words belong together.
    breaks = np.flatnonzero(np.diff(at) > 2 * SIZE) + 1
    out = []
    full = round(100 * SIMILARITY)
    for part in np.split(at, breaks):
        if part[-1] - part[0] + SIZE < min_words:
            continue
        # E equal ones of T shingles have the similarity E / (2 T - E), which is enough from i to j if level[j] + 100 - full >= level[i].
        level = (100 + full) * np.arange(len(part)) - 2 * full * part
        best = np.maximum.accumulate(level[::-1])
        last = len(part) - 1 - np.searchsorted(best, level - (100 - full), "left")
        ends = part[last] + SIZE
        long = ends - part >= min_words
        if not long.any():
            continue
        starts, reach = part[long], np.maximum.accumulate(ends[long])
        heads = np.flatnonzero(np.concatenate(([True], starts[1:] >= reach[:-1])))
        out += [(int(starts[i]), int(reach[j - 1])) for i, j in zip(heads, [*heads[1:], len(starts)], strict=True)]
    return out


def confirmed(meetings: DataFrame, docs: DataFrame, min_words: int) -> DataFrame:
    """(a, b, shift, sa, ea, sb, eb) in words: what of each meeting (a, b, shift) both full texts bear out.

    ``shift`` is the word in ``a`` minus the word in ``b`` at which both show the shared shingle. A meeting
    that is not borne out gives one row with sa NULL.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sides = []
                for name in ("text_a", "text_b"):
                    own = []
                    for _, _, data, offs in text_slices(part.column(name)):
                        hashes, _, _, first = words(data, offs)
                        own += [hashes[first[k] : first[k + 1]] for k in range(len(offs) - 1)]
                    sides.append(own)
                rows = []
                pairs = zip(*(part.column(c).to_pylist() for c in ("a", "b", "shifts")), strict=True)
                for k, a, b, shift in ((k, a, b, shift) for k, (a, b, shifts) in enumerate(pairs) for shift in shifts):
                    x, y = sides[0][k], sides[1][k]
                    lo_a, hi_a = max(0, shift), min(len(x), len(y) + shift)
                    equal = x[lo_a:hi_a] == y[lo_a - shift : hi_a - shift]
                    n = len(equal) - SIZE + 1
                    same = np.ones(max(n, 0), bool)
                    for s in range(SIZE if n > 0 else 0):
                        same &= equal[s : s + n]
                    found = _runs(same, min_words)
                    rows += [(a, b, shift, lo_a + s, lo_a + e, lo_a + s - shift, lo_a + e - shift) for s, e in found] or [(a, b, shift, None, None, None, None)]
                names = ["a", "b", "shift", "sa", "ea", "sb", "eb"]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 2 else pa.int32()) for k, c in enumerate(columns)], names)

    # A pair's texts travel once for all of its shifts, of which there are no more than keys in the text.
    pairs = meetings.groupBy("a", "b").agg(F.collect_set("shift").alias("shifts"))
    wide = pairs.join(docs.toDF("a", "text_a"), "a").join(docs.toDF("b", "text_b"), "b")
    return wide.select("a", "b", "shifts", "text_a", "text_b").mapInArrow(run, "a long, b long, shift int, sa int, ea int, sb int, eb int")


def run_keys(spots: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """(key, doc_id, at): hashes of the runs of ``length`` words around the shingles at ``spots`` (doc_id, at)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots_, ids = batch.column("spots").to_pylist(), batch.column("doc_id").to_pylist()
            for i, j, data, offs in text_slices(batch.column("text")):
                hashes, _, _, first = words(data, offs)
                out: list[tuple[int, int, int]] = []
                for k in range(i, j):
                    own = hashes[first[k - i] : first[k - i + 1]]
                    starts = {at - back for at in spots_[k] for back in range(0, length - SIZE + 1, SIZE)}
                    for s in sorted(x for x in starts if 0 <= x <= len(own) - length):
                        out.append((int((own[s : s + length] * _STEP[:length]).sum(dtype=np.uint64).view(np.int64)), ids[k], s))
                columns = list(zip(*out, strict=True)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.int32()], strict=True)], ["key", "doc_id", "at"])

    per_text = spots.groupBy("doc_id").agg(F.collect_list("at").alias("spots"))
    return docs.join(per_text, "doc_id").select("doc_id", "text", "spots").mapInArrow(run, "key long, doc_id long, at int")


def _with_first(keys: DataFrame) -> DataFrame:
    """Keys that occur more than once, with the first place of each; written to the shared folder."""
    place = [c for c in keys.columns if c != "key"]
    common = keys.groupBy("key").agg(F.count("*").alias("c"), F.min(F.struct(*place)).alias("first")).filter("c > 1").select("key", "first")
    return stash(keys.join(common, "key").select(*place, "first"), "keys")


def _meetings(met: DataFrame) -> DataFrame:
    return met.filter("first.doc_id <> doc_id or first.at <> at").select(
        F.col("doc_id").alias("a"), F.col("first.doc_id").alias("b"), (F.col("at") - F.col("first.at")).cast("int").alias("shift"))


def _unsettled(met: DataFrame, tested: DataFrame) -> DataFrame:
    """(doc_id, at): all places of the keys in which some place has no confirmed passage with the first around it.

    A passage elsewhere along the same alignment settles nothing. Settled places of such a key come along, as
    what they repeat of the first may be less like it than they are like the unsettled ones.
    """
    borne = tested.filter("sa is not null").select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("shift").alias("_shift"), "sa", "ea")
    other = (F.col("doc_id") != F.col("first.doc_id")) | (F.col("at") != F.col("first.at"))
    along = (F.col("doc_id") == F.col("_a")) & (F.col("first.doc_id") == F.col("_b")) & (F.col("at") - F.col("first.at") == F.col("_shift"))
    failed = met.filter(other).join(borne, along & (F.col("sa") <= F.col("at")) & (F.col("at") < F.col("ea")), "left_anti")
    keys = failed.select(F.col("first.doc_id").alias("_doc"), F.col("first.at").alias("_at")).distinct()
    return met.join(keys, (F.col("first.doc_id") == F.col("_doc")) & (F.col("first.at") == F.col("_at")), "left_semi").select("doc_id", "at").distinct()


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """(links, regions) of passages that occur more than once in ``docs`` (doc_id, text).

    links: a, b, sa, ea, sb, eb (words): the passage of ``a`` at sa is one of ``b`` at sb that comes first.
    regions: doc_id, start, end, cluster (a hash), one row per region. Texts under ``min_words`` words, NULL
    texts and NULL ids have none; rows that repeat a doc_id are taken as one text, the smallest.
    """
    narrow = _narrow(docs).filter("doc_id is not null")
    least = min_words - SIZE
    met = _with_first(paragraph_keys(narrow))
    low, high = (f"({x} & {mask})" for x, mask in (("around", 65535), ("around", -65536)))
    agree = F.expr(f"({low} != 0 and {low} = {low.replace('around', 'first.around')}) or ({high} != 0 and {high} = {high.replace('around', 'first.around')})")
    tested = stash(confirmed(_meetings(met.filter(agree)), narrow, least), "passages")
    again = _unsettled(met, tested)
    exact = _with_first(run_keys(again, narrow, least))
    second = confirmed(_meetings(exact), narrow, least)
    links = tested.union(second).filter("sa is not null").drop("shift")
    links = stash(links.distinct(), "passages")
    spans = links.select(F.col("a").alias("doc_id"), F.col("sa").alias("s"), F.col("ea").alias("e")).union(links.select("b", "sb", "eb")).distinct()
    by_place = Window.partitionBy("doc_id").orderBy("s", "e")
    reach = F.max("e").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(reach.isNull() | (F.col("s") >= reach), F.col("s")))
    spans = spans.select("doc_id", "s", "e", F.last("new", ignorenulls=True).over(by_place).alias("start"))
    spans = stash(spans, "spans")
    node = F.xxhash64("doc_id", "start")
    of_a = spans.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"), F.col("e").alias("ea"), node.alias("na"))
    of_b = spans.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"), F.col("e").alias("eb"), node.alias("nb"))
    edges = links.join(of_a, ["a", "sa", "ea"]).join(of_b, ["b", "sb", "eb"]).select(F.col("na").alias("a"), F.col("nb").alias("b"))
    clusters = components(edges)
    regions = spans.groupBy("doc_id", "start").agg(F.max("e").alias("end")).withColumn("node", node)
    regions = regions.join(clusters, "node", "left").select("doc_id", "start", "end", F.coalesce("component", "node").alias("cluster"))
    return links, regions


def removals(links: DataFrame) -> DataFrame:
    """doc_id, cuts (word runs that do not overlap, in order): what an earlier text, or an earlier place, holds."""
    spans = links.select(F.col("a").alias("doc_id"), F.col("sa").alias("s"), F.col("ea").alias("e")).distinct()
    by_place = Window.partitionBy("doc_id").orderBy("s", "e")
    reach = F.max("e").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(reach.isNull() | (F.col("s") > reach), F.col("s")))
    spans = spans.select("doc_id", "e", F.last("new", ignorenulls=True).over(by_place).alias("s"))
    runs = spans.groupBy("doc_id", "s").agg(F.max("e").alias("e"))
    return runs.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("cuts"))


def places(rows: DataFrame, fields: list[str], schema: str) -> DataFrame:
    """Adds start_char and end_char (code points) to word runs (start, end) of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, hi = [], []
            start, end = batch.column("start").to_numpy(), batch.column("end").to_numpy()
            for i, j, data, offs in text_slices(batch.column("text")):
                _, starts, ends, first = words(data, offs)
                points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                for k in range(i, j):
                    base = points[offs[k - i]]
                    lo.append(int(points[starts[first[k - i] + start[k]]] - base))
                    hi.append(int(points[ends[first[k - i] + end[k] - 1]] - base))
            yield pa.RecordBatch.from_arrays([*(batch.column(f) for f in fields), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], [*fields, "start_char", "end_char"])

    return rows.mapInArrow(run, schema)


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with all columns and rows; repeated passages are cut out of ``text`` except where they come first.

    A cut takes the white space after it along. Rows without a passage keep their text unchanged, NULL too;
    of rows that repeat a doc_id all are cut alike, within their length.
    """
    links, _ = repeated_passages(docs, min_words)
    cuts = removals(links)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, cut = [], batch.column("cuts").to_pylist()
            for i, j, data, offs in text_slices(batch.column("text")):
                _, starts, _, first = words(data, offs)
                for k in range(i, j):
                    lo, hi = first[k - i], first[k - i + 1]
                    base, end = int(offs[k - i]), int(offs[k - i + 1])
                    at, pieces = base, []
                    for c in cut[k]:
                        if lo + c["s"] >= hi:
                            continue
                        pieces.append(data[at : starts[lo + c["s"]]].tobytes())
                        at = int(starts[lo + c["e"]]) if lo + c["e"] < hi else end
                    out.append((b"".join(pieces) + data[at:end].tobytes()).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    named = _narrow(docs).filter("doc_id is not null")
    changed = named.join(cuts, "doc_id").select("doc_id", "text", "cuts").mapInArrow(run, "doc_id long, text string")
    key, text = free_name(docs, "_id"), free_name(docs, "_text")
    fresh = stash(changed.withColumnsRenamed({"doc_id": key, "text": text}), "cut")
    kept_rows = docs.join(fresh.select(key).distinct(), F.col("doc_id") == F.col(key), "left_anti")
    cut_rows = docs.join(fresh, F.col("doc_id") == F.col(key)).select(*[F.col(text).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
    return kept_rows.unionByName(cut_rows)
