"""Registered queries of the training-data operators: name -> (query, DuckDB SQL or None).

Each query applies its operator with production parameters to its whole table and derives
the digest columns that its contract names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episcope.llm import (decontamination, licences, ngram_join, packing, periodic_runs, secrets, sharding, spelling, suffix_dedup,
                          token_index, topk_search, toxicity, warc)
from episcope.llm.common import shared_path, ship_code, table, utf8_size


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (utf8_size(F.col("text")) + 16).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = sharding.interleave(docs, "source", "doc_id", shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_warc(table(spark, sf_dir, "pages"), shared_path(spark, "warc"), revisit_bytes=0)
    return warc.read_warc(archives).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest",
                                           "record_type", "refers_to")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"), size=3, percent=90)


OP3_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') w from documents),
s as (select doc_id, list_distinct(case when len(w) = 0 then []::varchar[] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) s from w),
n as (select doc_id, len(s)::bigint n from s),
e as (select doc_id, unnest(s) x from s),
both_ as (select a.doc_id a, b.doc_id b, count(*) c from e a join e b on a.x = b.x and a.doc_id <> b.doc_id group by all),
links as (select a, b from both_ join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 90 * (na.n + nb.n - c)),
reach(node, root) as (select doc_id, doc_id from n union select l.b, r.root from reach r join links l on l.a = r.node)
select n.doc_id, n.n n_shingles, min(root) component_id from n join reach on node = doc_id group by all
"""


def held_out(key: str = "doc_id") -> F.Column:
    """Rows that never train: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out()).select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                              (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), shared_path(spark, "tokens")
    shards = token_index.write_shards(docs, folder, tokenizer_path(), end_id=2)
    buckets = token_index.buckets_for(shards.agg(F.sum("docs")).first()[0] or 0, spark)
    token_index.build_index(shards, folder, buckets)
    found = token_index.lookup(token_index.all_keys(docs), folder, buckets, copy="copy")
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), width=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk_search.quantise(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256.0)
    return topk_search.topk_join(rows.filter("id % 50 = 0"), rows, k=5) \
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6_SQL = r"""
with d as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') w from documents),
i as (select distinct item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+') w from benchmark),
ik as (select item_id, w, least(len(w), 5) k from i where len(w) > 0),
ig as (select item_id, k, list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' ')) g from ik),
dg as (select doc_id, k, list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' ')) g
       from d, (select distinct k from ik)),
iu as (select item_id, k, len(g) m, unnest(g) x, unnest(range(len(g))) place from ig),
du as (select doc_id, k, len(g) n, g, unnest(range(len(g))) pos from dg),
wins as (select distinct doc_id, k, m, greatest(0, least(pos - place, n - m)) s, g from du join iu using (k) where g[pos + 1] = x),
wing as (select doc_id, k, m, s, unnest(g[s + 1:s + m]) x, len(g[s + 1:s + m]) len from wins),
wc as (select doc_id, k, m, s, x, len, count(*) c from wing group by all),
ic as (select item_id, k, m, x, count(*) c from iu group by all),
sim as (select doc_id, item_id, s, len + m - sum(least(wc.c, ic.c)) u, sum(least(wc.c, ic.c)) b
        from wc join ic using (k, m, x) group by doc_id, item_id, k, s, len, m)
select doc_id, item_id, arg_max(s, (b::double / u::double, -s))::int start_word, max(b::double / u::double) similarity
from sim where b * 100 >= u * 80 group by doc_id, item_id
"""


OP8_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) e from embeddings
           where embedding is not null and vec_id is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0)::bigint score
      from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e))
select query_id, rank::int rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s) where rank <= 5
"""


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = secrets.scan(docs, model=secrets.train(docs)).drop("text")

    def joined(found):
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = joined(F.filter("spans", lambda s: s["kind"] != "markov"))
    return out.select("doc_id", *[count(k) for k in ("assign", "access", "hex")],
                      F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0, window=1024)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of the documents whose crc32 h of the decimal id is a multiple of 10, the words from a on
    repeat the first p words of that tail (a, p from floor(h / 10)).  Rows without an id stay as they are."""
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    w = docs.filter("h % 10 = 0") \
        .withColumn("w", F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")) \
        .withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10)) \
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).otherwise(F.lit(0)).cast("int")) \
        .withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    # the tail's period as often as it begins, cut to the tail's length
    rest = F.col("n") - F.col("a")
    period = F.slice("w", F.col("a") + 1, F.least(F.col("p"), rest))
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    changed = w.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")).alias("text"))
    return docs.filter("h is null or h % 10 <> 0").select("doc_id", "text").unionByName(changed)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.find_runs(with_periodic_tails(table(spark, sf_dir, "documents")), least=12)
    # by length, then the smaller start and period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                              (-r["period"]).alias("period"))))
    line = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    return out.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(line.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def _crc32_sql(of: str) -> str:
    """DuckDB expression: crc32 of a list of byte values."""
    return (f"xor(list_reduce({of}, lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], "
            "lambda x, _: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295), 4294967295)")


OP11_SQL = r"""
with w0 as (select row_number() over () r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w, CRC h from documents),
w1 as (select *, len(w) n, h // 10 g, case when len(w) > 0 then (h // 10) % len(w) else 0 end a from w0),
w2 as (select *, 1 + (n - a) // (3 + g % 8) p from w1),
d as (select r, doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n), lambda i: case when i < a then w[i + 1] else w[a + (i - a) % p + 1] end)
                                else w end w from w2),
e as (select r, unnest(w) x, unnest(range(n)) i from d),
same as (select a.r, a.i, b.i - a.i q from e a join e b on a.r = b.r and a.x = b.x and a.i < b.i),
cut as (select *, i - row_number() over (partition by r, q order by i) island from same),
stretch as (select r, q, min(i) s, count(*) + q m from cut group by r, q, island),
runs as (select r, s, m, min(q) q from stretch where m >= greatest(12, 2 * q) group by r, s, m),
per as (select r, count(*) n_runs, max(struct_pack(m := m, s := -s, q := -q)) best,
               string_agg(s || ',' || m || ',' || q || chr(10), '' order by s, q) listed from runs group by r),
gone as (select distinct r, unnest(range(s + q, s + m)) i from runs),
kept as (select e.r, string_agg(x, ' ' order by e.i) t from e left join gone on e.r = gone.r and e.i = gone.i where gone.i is null group by e.r)
select d.doc_id, coalesce(n_runs, 0)::bigint n_runs, (-best.s)::bigint start, best.m::bigint length, (-best.q)::bigint period,
       (1000 * best.m // -best.q)::bigint exponent_milli, sha256(coalesce(listed, '')) runs_sha256, sha256(coalesce(t, '')) collapsed_sha256
from d left join per on d.r = per.r left join kept on d.r = kept.r
""".replace("CRC", _crc32_sql("list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)"))


def op12_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.start").alias("first_word"),
                      F.array_max("base.start").alias("last_word"), F.array_join("base_labels", ",").alias("base_labels"),
                      F.array_join("labels", ",").alias("labels"), "score")


def misspelt(words: DataFrame) -> DataFrame:
    """``word`` of each (doc_id, run): where 31 divides the crc32 h of "doc_id:run", the run's code point
    h % length is deleted.  Runs of rows without an id stay as they are."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    without = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return words.select(F.when(h % 31 == 0, without).otherwise(F.col("run")).alias("word"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.words_of(table(spark, sf_dir, "documents").select("doc_id", "text"), least=7)
    return spelling.variants(spelling.vocabulary(misspelt(runs), least=7, count=2))


OP13_SQL = r"""
with recursive r as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[a-z\x{C0}-\x{FF}]+')) run from documents),
rc as (select doc_id, run, count(*) c from r where length(run) >= 7 group by all),
rh as (select *, CRC h from rc),
w as (select case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end word, c from rh),
v as (select word, sum(c)::bigint n from w group by word having length(word) >= 7 and sum(c) >= 2),
gap as (select word, n, unnest(range(1, length(word) + 1)) i from v),
del as (select distinct word, n, substr(word, 1, i - 1) || substr(word, i + 1) cutout from gap),
rep as (select word, n, substr(word, 1, i - 1) || ' ' || substr(word, i + 1) mask from gap),
near as (select a.word, b.word near, b.n m from rep a join rep b on a.mask = b.mask and a.word <> b.word
         union all select l.word, s.word, s.n from del l join v s on l.cutout = s.word
         union all select s.word, l.word, l.n from del l join v s on l.cutout = s.word),
best as (select word, count(*) n_near, max(m) m from near group by word),
tied as (select near.word, min(near) near from near join best on near.word = best.word and near.m = best.m group by near.word),
f as (select v.word, v.n, coalesce(n_near, 0)::bigint n_near, case when best.m >= 10 * v.n then tied.near end form,
             case when best.m >= 10 * v.n then best.m end form_n
      from v left join best on v.word = best.word left join tied on v.word = tied.word),
walk(word, place) as (select word, word from f union select walk.word, f.form from walk join f on f.word = walk.place where f.form is not null),
root as (select walk.word, place root from walk join f on f.word = walk.place where f.form is null)
select f.word, form, root, n, n_near, form_n::bigint form_n from f join root on f.word = root.word
""".replace("CRC", _crc32_sql("flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c: case when ord(c) < 128 then [ord(c)::bigint] "
                              "else [195::bigint, ord(c)::bigint - 64] end))"))


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)
    return run


_QUERIES = {
    "op1_sharding": (op1_sharding, None),
    "op2_warc": (op2_warc, None),
    "op3_ngram_join": (op3_ngram_join, OP3_SQL),
    "op4_toxicity": (op4_toxicity, None),
    "op5_token_index": (op5_token_index, None),
    "op6_decontamination": (op6_decontamination, OP6_SQL),
    "op7_suffix_dedup": (op7_suffix_dedup, None),
    "op8_topk_search": (op8_topk_search, OP8_SQL),
    "op9_secrets": (op9_secrets, None),
    "op10_packing": (op10_packing, None),
    "op11_periodic_runs": (op11_periodic_runs, OP11_SQL),
    "op12_licences": (op12_licences, None),
    "op13_spelling": (op13_spelling, OP13_SQL),
}

QUERIES = {name: (_shipped(query), sql) for name, (query, sql) in _QUERIES.items()}
