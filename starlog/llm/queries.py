"""One query per operator over the test tables, with the SQL it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlog.llm import (
    byte_bpe,
    html_extract,
    imatch,
    language_id,
    line_dedup,
    packing,
    quality_rules,
    resample,
    secret_scan,
    simhash,
    token_counts,
    toxicity,
    vector_codes,
)
from starlog.session import scratch_path
from starlog.sources.files import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_OF_DOCUMENT = 50256  # free in the byte vocabulary


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


@query()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read_table(spark, sf_dir, "documents"), WORD_TOKENIZER, end_id=2)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def _secrets_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    kinds = " UNION ALL ".join(
        f"SELECT doc_id, {kind} AS kind, {quoted(rule.name)} AS name, t, {quoted(rule.pattern)} AS p, "
        f"regexp_extract_all(t, {quoted(rule.pattern)}) AS found, "
        f"string_split_regex(t, {quoted(rule.pattern)}) AS gaps, {rule.min_length} AS least, {rule.group} AS g FROM d"
        for kind, rule in enumerate(secret_scan.RULES)
    )
    value = " ".join(
        f"WHEN {kind} THEN regexp_extract(match, {quoted(rule.pattern)}, {rule.group})"
        for kind, rule in enumerate(secret_scan.RULES)
    )
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        m AS ({kinds}),
        e AS (SELECT doc_id, kind, name, least, unnest(found) AS match, unnest(gaps[1:len(found)]) AS gap,
              unnest(range(len(found))) AS i FROM m WHERE len(found) > 0),
        s AS (SELECT *, sum(length(gap) + length(match)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM e),
        k AS (SELECT doc_id, kind, name, CAST(stop - length(match) AS BIGINT) AS start,
              name || ':' || CAST(CAST(stop - length(match) AS BIGINT) AS VARCHAR) || ':'
              || CAST(CAST(stop AS BIGINT) AS VARCHAR) AS span
              FROM s WHERE length(CASE kind {value} END) >= least),
        a AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
              count(*) FILTER (kind = 2) AS n_hex,
              string_agg(span, ',' ORDER BY start, kind) FILTER (kind <= 2) AS base,
              string_agg(span, ',' ORDER BY start, kind) AS spans FROM k GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
               coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
               coalesce(spans, '') AS spans
        FROM d LEFT JOIN a USING (doc_id)
    """


@query(_secrets_sql())
def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"), scratch_path(spark, "ledger"))
    names = F.array(*[F.lit(rule.name) for rule in secret_scan.RULES])
    base = F.filter("findings", lambda x: x["kind"] < len(secret_scan.BASE))

    def count(kind: int):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{name}") for kind, name in enumerate(secret_scan.BASE)],
        F.sha2(secret_scan.as_text(base, names), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("findings"), names).alias("spans"),
    )


@query(
    r"""
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
    g AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS run
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
    r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS n FROM g) WHERE n > 1),
    c AS (SELECT doc_id, sum(least(8, i - before)) AS n_repeat_words FROM
          (SELECT doc_id, i, lag(i, 1, -8) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM r) GROUP BY doc_id),
    l AS (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM d),
    n AS (SELECT *, regexp_replace(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                 '[\x20\x09-\x0D]+', ' ', 'g') AS plain FROM l),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM n WHERE plain <> '' GROUP BY doc_id),
    f AS (SELECT source, plain, count(DISTINCT t) AS docs FROM n WHERE plain <> '' GROUP BY source, plain),
    x AS (SELECT source, plain FROM f WHERE docs > 10),
    gone AS (SELECT doc_id, sum(len(string_split(n.plain, ' '))) AS lost
             FROM n JOIN x ON n.source IS NOT DISTINCT FROM x.source AND n.plain = x.plain GROUP BY doc_id),
    b AS (SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                 length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 coalesce(n_dup_lines, 0) AS n_dup_lines,
                 CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
                 CAST(len(words) - coalesce(lost, 0) AS BIGINT) AS n_words_left
          FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN gone USING (doc_id)),
    v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
    SELECT *, NOT base_failed AND n_words_left >= 0.3 * n_words AS kept FROM v
    """
)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"), keep=["doc_id"])


@query()
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = html_extract.extract(read_table(spark, sf_dir, "pages"))
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "flat")
    docs = read_table(spark, sf_dir, "documents")
    manifest = token_counts.write_flat(docs, folder, BYTE_RANKS, public_tokenizers.PATTERN, END_OF_DOCUMENT)
    counts = token_counts.count_tokens(token_counts.list_files(spark, folder), folder, END_OF_DOCUMENT)
    return token_counts.with_doc_ids(counts, manifest)


@query()
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    """
    WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents),
    n AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM l),
    f AS (SELECT source, bare, count(DISTINCT doc_id) AS pages FROM n WHERE bare <> '' GROUP BY source, bare),
    h AS (SELECT source, count(*) AS all_pages FROM documents GROUP BY source),
    x AS (SELECT f.source, list(bare) AS common FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source
          WHERE pages >= 3 AND pages >= least(10, all_pages / 2) AND pages > 0.1 * all_pages GROUP BY f.source),
    k AS (SELECT d.doc_id, d.source, d.lang, d.text AS old, string_split(d.text, chr(10)) AS lines,
          list_filter(string_split(d.text, chr(10)), lambda s: NOT coalesce(list_contains(common,
            trim(s, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), false)) AS kept
          FROM documents d LEFT JOIN x ON d.source IS NOT DISTINCT FROM x.source)
    SELECT doc_id, source, lang, array_to_string(kept, chr(10)) AS text,
           coalesce(length(array_to_string(kept, chr(10))), 0) AS n_chars,
           coalesce(len(lines) - len(kept), 0) AS n_dropped FROM k
    """
)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return cut.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


@query()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.score(docs, model)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted, "passages")


@query()
def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = imatch.compare_edited(read_table(spark, sf_dir, "documents"))
    return compared.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")


def _resample_sql() -> str:
    # CRC-32 of the UTF-8 bytes of every distinct word, byte by byte over the table of the reflected polynomial
    return r"""
    WITH d AS (SELECT doc_id, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS parts FROM documents),
    b AS (SELECT string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS parts FROM benchmark),
    dw AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(parts) AS word FROM d)
           WHERE word <> '' GROUP BY doc_id, word),
    bw AS (SELECT word, count(*) AS n FROM (SELECT unnest(parts) AS word FROM b) WHERE word <> '' GROUP BY word),
    c AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
          CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc),
    w AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
    x AS (SELECT word, list_prepend(4294967295, list_transform(range(0, CAST(length(h) // 2 AS BIGINT)),
          lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))) AS bytes FROM w),
    k AS (SELECT word, xor(list_reduce(bytes, lambda a, y: xor(a >> 8, crc[xor(a & 255, y) + 1])), 4294967295) % 10000
          AS bucket FROM x, c),
    s AS (SELECT bucket, sum(n) AS s FROM dw JOIN k USING (word) GROUP BY bucket),
    t AS (SELECT bucket, sum(n) AS t FROM bw JOIN k USING (word) GROUP BY bucket),
    g AS (SELECT bucket, floor(1000 * ln((coalesce(CAST(t AS DOUBLE), 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)
          / ((CAST(s AS DOUBLE) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)))) AS gain
          FROM s LEFT JOIN t USING (bucket)),
    f AS (SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS total
          FROM dw JOIN k USING (word) JOIN g USING (bucket) GROUP BY doc_id),
    p AS (SELECT doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
          CAST(coalesce(floor(total / n_features), 0) AS BIGINT) AS weight,
          CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
          FROM d LEFT JOIN f USING (doc_id)),
    q AS (SELECT doc_id, n_features, weight,
          weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM p),
    r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able
          FROM q WHERE n_features >= 20)
    SELECT q.*, CASE WHEN place <= 10 * able // 100 THEN place END AS rank FROM q LEFT JOIN r USING (doc_id)
    """


@query(_resample_sql())
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighed = resample.weigh(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return resample.resample(weighed).select("doc_id", "n_features", "weight", "score", "rank")


@query()
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    found = language_id.identify(docs, language_id.fit(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def _vector_codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    steps = [
        f"""
        v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
              FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        z AS (SELECT CAST(any_value(len(ints)) // {parts} AS BIGINT) AS width FROM v),
        p AS (SELECT vec_id, label, part, ints[part * width + 1 : (part + 1) * width] AS x
              FROM v, z, (SELECT unnest(range({parts})) AS part)),
        b0 AS (SELECT part, entry, x AS c FROM
               (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM p)
               WHERE entry < {entries})"""
    ]
    away = "list_sum(list_transform(list_zip(x, c), lambda y: (y[1] - y[2]) * (y[1] - y[2])))"
    for at in range(rounds + 1):
        steps.append(
            f"""
        a{at} AS (SELECT vec_id, label, part, any_value(x) AS x, min(struct_pack(away := away, entry := entry)) AS best FROM
              (SELECT vec_id, label, p.part, x, CAST({away} AS BIGINT) AS away, entry FROM p JOIN b{at} USING (part))
              GROUP BY vec_id, label, part)"""
        )
        if at < rounds:
            steps.append(
                f"""
        m{at} AS (SELECT part, entry, list(mean ORDER BY place) AS c FROM
              (SELECT part, best.entry AS entry, place, CAST(floor(sum(CAST(x[place] AS BIGINT)) / count(*)) AS BIGINT) AS mean
               FROM a{at}, z, (SELECT unnest(range(1, 1025)) AS place) WHERE place <= width GROUP BY part, best.entry, place)
              GROUP BY part, entry),
        b{at + 1} AS (SELECT part, entry, coalesce(m{at}.c, b{at}.c) AS c FROM b{at} LEFT JOIN m{at} USING (part, entry))"""
            )
    return f"""
        WITH {",".join(steps)},
        r AS (SELECT vec_id, label, string_agg(lower(printf('%02x', best.entry)), '' ORDER BY part) AS code,
              CAST(sum(best.away) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id, label),
        l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM r GROUP BY label),
        h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, label_error, codebooks_sha256
        FROM r JOIN l ON r.label IS NOT DISTINCT FROM l.label, h
    """


@query(_vector_codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coding = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_error(coding.rows).withColumn("code", F.lower(F.hex("code")))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(coding.fingerprint()).alias("codebooks_sha256"))
