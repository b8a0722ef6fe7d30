"""The corpus operators as named queries over the test tables.

Each query applies its operator, with production parameters, to the whole of
its table; the digest columns are derived from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from drayline.llm import use_small_batches
from drayline.registry.base import Query, Tables
from drayline.session import RunFolder, use_utc

QUERIES: dict[str, Query] = {}


def vocabulary(name: str) -> str:
    """Where a public vocabulary file is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _corpus_query(name: str, sql: str | None = None):
    """Register ``function(tables, run) -> DataFrame``; the run's folder ends with the query."""

    def register(function: Callable[[Tables, RunFolder], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            use_small_batches(spark)
            folder = RunFolder(spark, name)
            try:
                return folder.result(function(Tables(spark, sf_dir), folder))
            except BaseException:
                folder.close()
                raise

        QUERIES[name] = Query(name, run, sql)
        return function

    return register


OP1_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 199)) AS i, h FROM d WHERE length(h) >= 400),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM s),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY m) AS n FROM w) WHERE n > 1),
c AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS cut FROM r),
g AS (SELECT doc_id, i, sum(cut) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM c),
p AS (SELECT doc_id, span, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY doc_id, span),
q AS (SELECT p.doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY p.doc_id ORDER BY a), 0) AS before FROM p),
k AS (SELECT q.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
        string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS head
      FROM q JOIN d USING (doc_id) GROUP BY q.doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@_corpus_query("op1_suffix_dedup", OP1_SQL)
def op1_suffix_dedup(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.suffix_dedup import repeated_spans

    return repeated_spans(t.documents.select("doc_id", "text"), run, want_text=False)


@_corpus_query("op10_simhash_dedup")
def op10_simhash_dedup(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.simhash_dedup import near_duplicates

    found = near_duplicates(t.documents.select("doc_id", "text"), run)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


OP6_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
x AS (SELECT doc_id, i, ws[i] AS word, CASE WHEN i + 49 <= len(ws) THEN md5(array_to_string(ws[i:i + 49], ' ')) END AS m FROM p),
f AS (SELECT doc_id, i, word, m IS NOT NULL AND min(doc_id) OVER (PARTITION BY m) < doc_id AS hit FROM x),
g AS (SELECT doc_id, i, word, max(CASE WHEN hit THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
k AS (SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM g GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""


@_corpus_query("op6_window_dedup", OP6_SQL)
def op6_window_dedup(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.window_dedup import repeated_windows

    return repeated_windows(t.documents.select("doc_id", "text"), run, want_text=False)


@_corpus_query("op2_pack")
def op2_pack(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.packing import pack_documents

    return pack_documents(t.documents.select("doc_id", "text"), run, vocabulary("word_bpe_49k.json"), want_ids=False)


@_corpus_query("op9_token_files")
def op9_token_files(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.token_files import round_trip

    return round_trip(t.documents.select("doc_id", "text"), run, vocabulary("word_bpe_49k.json"), want_ids=False)


@_corpus_query("op4_merkle_fingerprint")
def op4_merkle_fingerprint(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.merkle import edited_fingerprints

    return edited_fingerprints(t.documents.select("doc_id", "text"), run)


@_corpus_query("op7_shards")
def op7_shards(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.sharding import LAW, read_shards, write_shards

    docs = t.documents.select("doc_id", "text")
    write_shards(docs, f"{run.path}/shards", 8)
    text = F.coalesce("text", F.lit(""))
    return read_shards(t.spark, f"{run.path}/shards", docs.schema).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_corpus_query("op8_language")
def op8_language(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.language_id import fit, predict

    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    docs = t.documents.select("doc_id", "text", "lang").withColumn("held_out", held_out)
    models = fit(docs.where(~F.col("held_out")))
    found = predict(docs.select("doc_id", "text", "held_out"), models)
    return found.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS good FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.good AND b.good AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON r.a = l.a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links, min(c) AS component_id, min(c) = vec_id AS kept
FROM v JOIN r ON r.a = v.vec_id GROUP BY vec_id
"""


@_corpus_query("op5_embedding_dedup", OP5_SQL)
def op5_embedding_dedup(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.embedding_dedup import near_duplicates

    return near_duplicates(t.embeddings.select("vec_id", "embedding"), run)


@_corpus_query("op3_sentencepiece")
def op3_sentencepiece(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.sentencepiece_codec import round_trip

    return round_trip(t.documents.select("doc_id", "text"), vocabulary("piece_bpe_32k.model"))


@_corpus_query("op11_token_alignment")
def op11_token_alignment(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.token_alignment import align_tokens

    docs = t.documents.select("doc_id", "text")
    return align_tokens(docs, run, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@_corpus_query("op13_warc")
def op13_warc(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.warc import capture_index, write_archives

    write_archives(t.pages, run, f"{run.path}/archives", least_bytes=0)
    index = capture_index(t.spark, f"{run.path}/archives", run)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "part", "place")


OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4), (5)) v(k)),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
x AS (SELECT lang, k, phrase, f AS a, ws, unnest(range(1, k)) AS j FROM c),
s AS (SELECT x.lang, x.phrase, a, j, l.f AS l, r.f AS r, n, (CAST(1000 AS HUGEINT) * a * n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(ws[1:j], ' ')
  JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(ws[j + 1:x.k], ' ') JOIN t ON t.lang = x.lang),
m AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS q FROM s),
y AS (SELECT lang, f, ws, z, unnest(range(1, k - z + 2)) AS i FROM c, (VALUES (2), (3), (4)) v(z) WHERE z < k),
o AS (SELECT lang, array_to_string(ws[i:i + z - 1], ' ') AS phrase, max(f) AS longer FROM y GROUP BY ALL),
k AS (SELECT m.lang, m.phrase, a, l, r, n, score, row_number() OVER (PARTITION BY m.lang ORDER BY score DESC, a DESC, m.phrase) AS rank
  FROM m LEFT JOIN o ON o.lang = m.lang AND o.phrase = m.phrase WHERE q = 1 AND (longer IS NULL OR 100 * longer < 100 * a))
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM k WHERE rank <= 2000
"""


@_corpus_query("op12_collocations", OP12_SQL)
def op12_collocations(t: Tables, run: RunFolder) -> DataFrame:
    from drayline.llm.collocations import collocations

    return collocations(t.documents.select("text", "lang"), run, least=100, longest=5, first=2000)
