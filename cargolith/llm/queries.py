"""One registered query per operator, over its whole table, with SQL where SQL can state the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolith.llm import ann, bpe, chat, digests, idfiles, lexical, neardup, packing, personal, quality, resample, substring, vecdup
from cargolith.llm.common import read_table, stash


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, end (code points), n_words, cluster, kept: each region of text that occurs more than once.

    ``kept`` says that no earlier text (or place) holds the region, or any part of it.
    """
    docs = read_table(spark, folder, "documents")
    links, regions = substring.repeated_passages(docs)
    cuts = substring.removals(links).select("doc_id", F.explode("cuts").alias("cut"))
    held = regions.join(cuts, (regions["doc_id"] == cuts["doc_id"]) & (F.col("cut.s") < F.col("end")) & (F.col("cut.e") > F.col("start")), "left").groupBy(
        regions["doc_id"], "start", "end", "cluster").agg((F.count("cut") == 0).alias("kept"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    rows = stash(held, "regions").join(texts, "doc_id").select("doc_id", "text", "start", "end", "cluster", "kept")
    placed = substring.places(rows, ["doc_id", "start", "end", "cluster", "kept"], "doc_id long, start int, end int, cluster long, kept boolean, start_char long, end_char long")
    return placed.select("doc_id", F.col("start_char").alias("start"), F.col("end_char").alias("end"), (F.col("end") - F.col("start")).alias("n_words"), "cluster", "kept")


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(read_table(spark, folder, "documents"), str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op4_minhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, folder, "documents"), size=3, per_cent=85)


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal.digests(read_table(spark, folder, "documents"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(read_table(spark, folder, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))


def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.formatted(read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(extra))


def op8_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return vecdup.vector_duplicates(read_table(spark, folder, "embeddings"))


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.neighbours(read_table(spark, folder, "embeddings"))


def op10_id_files(spark: SparkSession, folder: str) -> DataFrame:
    return idfiles.round_trip(read_table(spark, folder, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """See ``digests.exact_duplicates``."""
    return digests.exact_duplicates(read_table(spark, folder, "documents"))


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """See ``resample.resampled``: documents towards the distribution of the benchmark texts."""
    return resample.resampled(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """See ``lexical.ranked``: the 20 best documents of each benchmark item."""
    return lexical.ranked(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_byte_bpe, op3_quality, op4_minhash_neardup, op5_personal_data, op6_packing, op7_chat, op8_embedding_neardup, op9_neighbours, op10_id_files,
    op11_exact_dedup, op12_importance_resampling, op13_lexical_search)}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = {
    "op4_minhash_neardup": f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select doc_id, array_to_string(w, ' ') as g from w where len(w) in (1, 2)
  union select doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w where len(w) > 2)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by all),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
both_ways as (select a, b from e union all select b, a from e),
reach(node, root) as (select doc_id, doc_id from documents union select l.b, r.root from reach r join both_ways l on l.a = r.node where r.root < l.b)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, r.root as component_id, d.doc_id = r.root as kept
from documents d left join n using (doc_id) join (select node, min(root) as root from reach group by node) r on r.node = d.doc_id
""",
    "op11_exact_dedup": f"""
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size, doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from (select doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') as t from documents)
""",
    "op12_importance_resampling": f"""
with recursive
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
df as (select doc_id, unnest(w) as f from d union all select doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from d),
bf as (select unnest(w) as f from b union all select unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from b),
step(i, c, k) as (select i, i, 0 from range(256) r(i) union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from step where k < 8),
tab as (select i, c from step where k = 8),
walk(f, h, c, p) as (select f, hex(encode(f)), 4294967295, 0 from (select f from df union select f from bf)
  union all select f, h, xor(walk.c >> 8, tab.c), p + 1 from walk join tab on tab.i = xor(walk.c, ('0x' || substr(h, 2 * p + 1, 2))::bigint) & 255 where 2 * p < length(h)),
bucket as (select f, xor(c, 4294967295) % 10000 as k from walk where 2 * p = length(h)),
dc as (select k, count(*) as s from df join bucket using (f) group by k),
bc as (select k, count(*) as t from bf join bucket using (f) group by k),
gain as (select k, floor(1000 * ln((coalesce(t, 0) + 1)::double * ((select sum(s) from dc) + 10000)::double
  / ((coalesce(s, 0) + 1)::double * ((select coalesce(sum(t), 0) from bc) + 10000)::double)))::bigint as g from dc full join bc using (k)),
part as (select doc_id, count(*) as n, floor(sum(g)::double / count(*))::bigint as w from df join bucket using (f) join gain using (k) group by doc_id),
scored as (select doc_id, coalesce(n, 0)::bigint as n_features, coalesce(p.w, 0)::bigint as weight,
  (coalesce(p.w, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double))))::bigint as score, len(d.w) >= 20 as able
  from d left join part p using (doc_id)),
ranked as (select *, case when able then row_number() over (partition by able order by score desc, doc_id) end as r, count(*) filter (able) over () as n from scored)
select doc_id, n_features, weight, score, case when r <= 25 * n // 100 then r end as rank from ranked
""",
    "op13_lexical_search": f"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
i as (select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from benchmark),
q as (select item_id, t, count(*) as c from (select item_id, unnest(w) as t from i) group by all),
p as (select doc_id, t, count(*) as tf from (select doc_id, unnest(w) as t from d) where t in (select t from q) group by all),
total as (select count(*)::bigint as docs, sum(len(w))::bigint as length from d where len(w) > 0),
m as (select doc_id, 75 + (25 * len(w)::bigint * docs) // length as m from d, total where len(w) > 0),
f as (select t, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from p, total group by t, docs),
s as (select item_id, doc_id, sum(c * f.w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score from q join p using (t) join f using (t) join m using (doc_id) group by all),
r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank, doc_id, score from s where score > 0)
select * from r where rank <= 20
""",
    "op8_embedding_neardup": """
with recursive v as (select vec_id, embedding::double[] as x from embeddings),
u as (select vec_id, x, sqrt(list_inner_product(x, x)) as norm from v),
e as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id and list_inner_product(a.x, b.x) >= 0.9 * a.norm * b.norm),
reach(node, root) as (select vec_id, vec_id from v union select e.b, r.root from reach r join e on e.a = r.node where r.root < e.b)
select v.vec_id, coalesce(l.n, 0)::bigint as n_links, r.root as component_id, v.vec_id = r.root as kept
from v left join (select a, count(*) as n from e group by a) l on l.a = v.vec_id join (select node, min(root) as root from reach group by node) r on r.node = v.vec_id
""",
}
