"""The training-data operators as queries on the driver tables, with SQL where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    alignment,
    chat,
    common,
    divergence,
    exact_dedup,
    langid,
    licences,
    mixing,
    ngram_join,
    packing,
    sharding,
    topk,
    vector_dedup,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query()
def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for mark in chat.CONTROL:
        out = f"replace({out}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return out


@query(f"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                         (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), ''))
            AS loss_sha256,
        CAST(sum(length('{chat.TURN}' || {_escaped('role')} || '{chat.SAYS}'
            || {_escaped('text')} || '{chat.END}')) AS BIGINT) AS formatted_chars
    FROM rows GROUP BY conv_id
""")
def op5_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.sql(
        f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') "
        "AS t(conv_id, turn, role, text)"
    )
    rows = table(spark, sf, "conversations").select(more.columns).union(more)
    turns = rows.withColumn("parts", chat.text_parts(F.col("text")))
    read = chat.read_back(common.landed(chat.format_turns(turns), "chats"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query("""
    WITH facts AS (
        SELECT d.doc_id, d.source,
            CAST(coalesce(len(regexp_extract_all(d.text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT)
                AS size,
            -ln((('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 12))
                ::BIGINT + 1) / 281474976710658.0::DOUBLE)
                / CASE WHEN q >= 1 THEN 2.0 WHEN q <= 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS key
        FROM documents d
        LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id) USING (doc_id)
    ), sizes AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
            CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
        FROM facts GROUP BY source
    ), limits AS (
        SELECT *, 3 * source_size / weight AS edge,
            sum(source_size) OVER () AS total,
            coalesce(sum(3 * source_size) OVER w, 0) AS capped,
            sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS free
        FROM sizes WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), leveled AS (
        SELECT *, (SELECT min_by(CAST(total - capped AS DOUBLE) / CAST(free AS DOUBLE), edge)
            FROM limits WHERE CAST(total - capped AS DOUBLE) / CAST(free AS DOUBLE) < edge) AS level
        FROM limits
    ), sources AS (
        SELECT source, source_size,
            least(CAST(3 * source_size AS DOUBLE), weight * level) AS target
        FROM leveled
    ), ordered AS (
        SELECT f.doc_id, f.size, s.source_size, s.target,
            CASE WHEN s.source_size > 0
                THEN CAST(floor(s.target / s.source_size) AS BIGINT) ELSE 0 END AS epochs,
            coalesce(sum(f.size) OVER (PARTITION BY f.source ORDER BY key, f.doc_id, f.size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM facts f JOIN sources s ON f.source IS NOT DISTINCT FROM s.source
    )
    SELECT doc_id, size, source_size, target,
        CAST(size * (epochs + CASE WHEN size > 0
            AND 2 * before + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
    FROM ordered
""")
def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    sized = table(spark, sf, "documents").select(
        "doc_id", "source", common.word_count(F.col("text")).alias("words")
    )
    docs = mixing.labelled(sized, table(spark, sf, "labels"))
    mix = mixing.mix(docs, mixing.quality_weight(F.col("__quality")), F.col("words"))
    return mix.documents.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    told = langid.identify(table(spark, sf, "documents"))
    return told.select(
        "doc_id",
        langid.held_out(F.col("doc_id")).alias("held_out"),
        F.col("__lang").alias("lang_pred"),
        F.col("__score").alias("score"),
    )


@query("""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 3 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END
        ) AS s
        FROM words
    ), sizes AS (
        SELECT doc_id, count(s) AS n FROM words LEFT JOIN shingles USING (doc_id) GROUP BY 1
    ), links AS (
        SELECT a.doc_id AS u, b.doc_id AS v
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
        JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
        GROUP BY 1, 2 HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))
    ), reach(u, r) AS (
        SELECT doc_id, doc_id FROM documents
        UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.r
    )
    SELECT doc_id, n AS n_shingles, component
        AS component_id FROM sizes
    JOIN (SELECT u AS doc_id, min(r) AS component FROM reach GROUP BY 1) USING (doc_id)
""")
def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.groups(table(spark, sf, "documents"))


@query("""
    WITH RECURSIVE sound AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding,
            lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
        SELECT a.vec_id AS u, b.vec_id AS v FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= 0.9
    ), reach(u, r) AS (
        SELECT vec_id, vec_id FROM embeddings
        UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.r
    ), parts AS (SELECT u AS vec_id, min(r) AS component_id FROM reach GROUP BY 1)
    SELECT vec_id, (SELECT count(*) FROM links WHERE u = vec_id) AS n_links, component_id,
        vec_id = component_id AS kept
    FROM parts
""")
def op10_vector_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return vector_dedup.groups(table(spark, sf, "embeddings"))


@query("""
    WITH whole AS (
        SELECT row_number() OVER () AS row, vec_id,
            list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.row AS query, q.vec_id AS query_id, c.vec_id,
            CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM whole q JOIN whole c ON q.row <> c.row WHERE q.vec_id % 100 = 0
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS place
        FROM scored
    )
    SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
""")
def op7_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"))


@query("""
    WITH facts AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
            sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), firsts AS (
        SELECT payload_digest, min(page_id) AS first FROM facts
        WHERE payload_bytes >= 100 GROUP BY payload_digest
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to
    FROM facts LEFT JOIN firsts USING (payload_digest)
""")
def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    records = warc.write_and_read(table(spark, sf, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op4_hilbert_sharding(spark: SparkSession, sf: str) -> DataFrame:
    cut = sharding.assign(table(spark, sf, "documents"))
    return cut.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query()
def op9_licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licences.scan(table(spark, sf, "documents"))


@query("""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    found AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
    FROM texts JOIN found USING (text)
""")
def op13_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf, "documents")).documents


@query("""
    WITH docs AS (
        SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                AS text
        FROM documents
    ), words AS (
        SELECT row, lang, source,
            unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM docs
    ), counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
    kept AS (
        SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 10
    ), langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    grid AS (
        SELECT lang, source, term, coalesce(n, 0) AS n, lang_n, v, lang_total,
            sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total
        FROM groups JOIN kept USING (lang) JOIN langs USING (lang)
        LEFT JOIN counts USING (lang, source, term)
    ), shares AS (
        SELECT *, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS p,
            1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v) AS q
        FROM grid
    ), sums AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY ALL
    ), items AS (
        SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(value, 0) AS value
        FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
        LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = o.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares
        WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
        FROM items
    )
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR place <= 10
""")
def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


@query()
def op11_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.totals(alignment.align(table(spark, sf, "documents")))
