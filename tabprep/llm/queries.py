"""The registered queries of this package: thin digests of each operator's result over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm import (
    alignment, bpe, embed_dedup, hamming_index, infill, language, mixing, quality_model, quality_rules, secret_scan, sharding, simhash,
    suffix_dedup,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def sql_in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


RULES = quality_rules.Limits()


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark, root):
    docs = read(spark, root, "documents").select("doc_id", "text")
    return suffix_dedup.dedup(docs, out=("n_bytes", "n_removed", "n_spans", "kept_sha256"))


@query("op2_bpe")
def op2_bpe(spark, root):
    docs = read(spark, root, "documents").select("doc_id", "text")
    return bpe.encode(docs, out=("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


@query("op3_simhash")
def op3_simhash(spark, root):
    found = simhash.near_duplicates(read(spark, root, "documents").select("doc_id", "text"))
    code = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", code.alias("fingerprint"), "component_id")


@query("op4_embedding_dedup")
def op4_embedding_dedup(spark, root):
    return embed_dedup.near_duplicates(read(spark, root, "embeddings"))


@query("op5_quality_rules", rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
          FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
    t AS (SELECT doc_id, i, word, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM w
          WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, b, c) AS n FROM t
              WHERE c IS NOT NULL) WHERE n > 1),
    rep AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id),
    l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
    j AS (SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
                 len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
                 len(regexp_extract_all(regexp_replace(line, '([\x20\x09-\x0D])', '\1\1', 'g'),
                     '(?:^|[\x20\x09-\x0D])[|»›•·]+(?:[\x20\x09-\x0D]|$)')) AS seps,
                 len(regexp_extract_all(line, '(?:[#$%&*^~=<>|+]{{2,}}|!{{2,}}|\?{{3,}})')) AS marks FROM l),
    f AS (SELECT doc_id, line, chars, n, n > 0 AND (
              (seps >= {RULES.separators} AND seps >= n * {RULES.separator_share})
              OR (n < {RULES.short_line} AND NOT regexp_matches(line, '[.!?…:;。！？]["''”’»)\]]*[\x20\x09-\x0D]*$'))
              OR (marks >= 2 AND marks >= n * {RULES.marked_share}) OR NOT regexp_matches(line, '[\pL\pN]')
              OR (n <= {RULES.notice_words} AND regexp_matches(line, '(?:©|\([Cc]\)|[Cc]opyright)[\x20,]*(?:19|20)[0-9]{{2}}'))
              OR len(regexp_extract_all(line, '(?:https?://|www\.)[^\x20\x09-\x0D]+')) >= greatest(1, n * {RULES.address_share})
              OR coalesce(list_sum(list_transform(list_filter([{sql_in(quality_rules.BOILERPLATE)}], lambda p: contains(lower(line), p)),
                     lambda p: len(p))), 0) >= greatest(1, len(line) * {RULES.phrase_share})) AS fails
          FROM j),
    per AS (SELECT doc_id, coalesce(sum(chars), 0)::BIGINT AS word_chars, sum(n)::BIGINT AS n_words,
                   coalesce(sum(chars) FILTER (fails), 0) AS lost,
                   (count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0))::BIGINT AS n_dup_lines
            FROM f GROUP BY doc_id),
    b AS (SELECT doc_id, n_words, word_chars, lost, n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                 (len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                 n_words < {RULES.min_words} OR 100 * coalesce(n_repeat_words, 0) > {RULES.max_repeat_percent} * n_words AS base_failed
          FROM d JOIN per USING (doc_id) LEFT JOIN rep USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND (word_chars = 0 OR 1 - (word_chars - lost) / word_chars <= {RULES.max_lost}) AS kept FROM b
""")
def op5_quality_rules(spark, root):
    judged = quality_rules.judge(read(spark, root, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op6_sharding", """
    WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
                   CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS crc),
    d AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 8 AS size FROM documents),
    h AS (SELECT doc_id, size, hex(encode(text)) AS h FROM d),
    b AS (SELECT doc_id, size, list_transform(range(size - 8), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT) AS bytes FROM h),
    c AS (SELECT doc_id, size, xor(list_reduce(bytes, lambda a, x: xor(a >> 8, crc[(xor(a, x) & 255) + 1]), 4294967295), 4294967295)
                 AS text_crc32 FROM b, t),
    p AS (SELECT *, sum(size) OVER (ORDER BY doc_id) AS upto, sum(size) OVER () AS total FROM c),
    s AS (SELECT *, least(23, ((2 * upto - size) * 24) // (2 * total))::INT AS shard FROM p)
    SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
           row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INT AS grown_shard FROM s
""")
def op6_sharding(spark, root):
    rows = read(spark, root, "documents").select(
        "doc_id", sharding.byte_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("bigint").alias("text_crc32"))
    placed = sharding.shard_by_bytes(rows, "size", ["doc_id"], 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _certain(rounds: int) -> str:
    """CTEs that scale inclusion probabilities again without the documents that have become certain."""
    return " ".join(f"""
    e{n} AS (SELECT e.*, CASE WHEN e.room > 0 THEN greatest(e.c{n - 1}, coalesce((e.room - coalesce(x.words, 0)) / nullif(x.squares, 0), e.c{n - 1}))
                         ELSE 0 END AS c{n}
             FROM e{n - 1 if n > 1 else ""} e LEFT JOIN (
                 SELECT d.source, sum(d.size) FILTER (d.size * s.c{n - 1} >= 1)::DOUBLE AS words,
                        sum(d.size::HUGEINT * d.size) FILTER (NOT d.size * s.c{n - 1} >= 1)::DOUBLE AS squares
                 FROM d JOIN e{n - 1 if n > 1 else ""} s ON d.source IS NOT DISTINCT FROM s.source GROUP BY d.source) x
             ON e.source IS NOT DISTINCT FROM x.source),""" for n in range(1, rounds + 1))


MIX = mixing.Mix()


@query("op7_mixing", r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
               (('0x' || md5(concat_ws('|', 'mix-1', doc_id::VARCHAR, text))[1:13])::BIGINT + 0.5) / 4503599627370496.0::DOUBLE AS u
        FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
          FROM d GROUP BY source),
    total AS (SELECT sum(source_size) * 1.5::DOUBLE AS budget FROM s),
    level AS (
        SELECT 0.0::DOUBLE AS lvl, -1 AS n
        UNION ALL
        SELECT ((SELECT budget FROM total) - x.used) / x.rest, x.n FROM (
            SELECT l.n AS before, count(*) FILTER (w * lvl > 2 * source_size) AS n,
                   coalesce(sum(2 * source_size) FILTER (w * lvl > 2 * source_size), 0)::DOUBLE AS used,
                   sum(w) FILTER (w * lvl <= 2 * source_size) AS rest
            FROM s, level l GROUP BY l.n, l.lvl) x WHERE x.n > x.before AND x.rest > 0),
    t AS (SELECT source, source_size, least(2.0 * source_size, w * (SELECT max(lvl) FROM level)) AS target FROM s),
    q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::INT ELSE 0 END AS sure,
                 CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0 END AS share FROM t),
    e AS (SELECT *, floor(target - sure * source_size)::BIGINT AS room, 0.0::DOUBLE AS c0 FROM q),
    {CERTAIN}
    r0 AS (SELECT d.*, source_size, target, sure, share, room,
                  CASE WHEN size * c{LAST} >= 1 THEN 0.0 WHEN size * c{LAST} > 0
                       THEN (u / (1 - u)) / ((size * c{LAST}) / (1 - size * c{LAST})) ELSE 'infinity'::DOUBLE END AS rank
           FROM d JOIN e{LAST} q ON d.source IS NOT DISTINCT FROM q.source),
    r1 AS (SELECT *, share > 0 AND sum(size) OVER (PARTITION BY source ORDER BY rank) <= room AS in0 FROM r0),
    g1 AS (SELECT *, room - coalesce(sum(size) FILTER (in0) OVER (PARTITION BY source), 0) AS room1 FROM r1),
    r2 AS (SELECT *, share > 0 AND NOT in0 AND size <= room1 AND sum(size) FILTER (NOT in0 AND size <= room1)
                  OVER (PARTITION BY source ORDER BY rank) <= room1 AS in1 FROM g1),
    g2 AS (SELECT *, room1 - coalesce(sum(size) FILTER (in1) OVER (PARTITION BY source), 0) AS room2 FROM r2),
    r3 AS (SELECT *, share > 0 AND NOT in0 AND NOT in1 AND size <= room2 AND sum(size) FILTER (NOT in0 AND NOT in1 AND size <= room2)
                  OVER (PARTITION BY source ORDER BY rank) <= room2 AS in2 FROM g2),
    g3 AS (SELECT *, room2 - coalesce(sum(size) FILTER (in2) OVER (PARTITION BY source), 0) AS room3,
                  share > 0 AND NOT in0 AND NOT in1 AND NOT in2 AS free FROM r3),
    r4 AS (SELECT *, free AND size > room3 AND size - room3 < room3
                  AND row_number() OVER (PARTITION BY source, free AND size > room3 ORDER BY size, rank) = 1 AS in3 FROM g3)
    SELECT doc_id, size, source_size, target, (size * (sure + (in0 OR in1 OR in2 OR in3)::INT))::BIGINT AS taken FROM r4
""".replace("{CERTAIN}", _certain(MIX.certain_rounds)).replace("{LAST}", str(MIX.certain_rounds)))
def op7_mixing(spark, root):
    planned = mixing.plan(read(spark, root, "documents").select("doc_id", "text", "source"))
    return planned.select("doc_id", "size", "source_size", "target", "taken")


def remainder(parts: int):
    """crc32 of the id as text, modulo `parts`."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


@query("op8_quality_classifier")
def op8_quality_classifier(spark, root):
    docs = read(spark, root, "documents").select("doc_id", "text")
    labels = read(spark, root, "labels").select("doc_id", "quality").where(remainder(3) != 1)
    model = quality_model.fit(docs, labels)
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    return model.transform(docs.withColumn("held_out", held_out))


@query("op9_language_id")
def op9_language_id(spark, root):
    docs = read(spark, root, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(remainder(4) != 2))
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    return model.transform(docs.select("doc_id", "text", held_out.alias("held_out")))


@query("op10_secret_scan")
def op10_secret_scan(spark, root):
    found = secret_scan.find(read(spark, root, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda x: x["kind"].isin(*[r.kind for r in secret_scan.BASE]))
    return found.select(
        "doc_id",
        *[secret_scan.count_of(F.col("spans"), r.kind).alias(f"n_{r.kind}") for r in secret_scan.BASE],
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


@query("op11_token_alignment")
def op11_token_alignment(spark, root):
    docs = read(spark, root, "documents").select("doc_id", "text")
    out = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return alignment.align(docs, out=out).select("doc_id", *out)


@query("op12_fill_in_middle", r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id::VARCHAR) AS h FROM documents),
    u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units,
                 list_transform([1, 9, 17, 25], lambda i: ('0x' || h[i:i + 7])::BIGINT) AS draw FROM d),
    n AS (SELECT *, len(units)::BIGINT AS n, draw[1] % (len(units) + 1) AS x, draw[2] % (len(units) + 1) AS y,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                           OR draw[3] % 100 >= 100 THEN 'plain'
                      WHEN draw[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT *, array_to_string(units[1:least(x, y)], '') AS prefix,
                 array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS middle,
                 array_to_string(units[greatest(x, y) + 1:], '') AS suffix FROM n)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                  ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256 FROM p
""")
def op12_fill_in_middle(spark, root):
    docs = read(spark, root, "documents").select("doc_id", "text")
    out = ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    return infill.fill_in_middle(docs, out=out).select("doc_id", *out)


@query("op13_nearest_neighbours")
def op13_nearest_neighbours(spark, root):
    return hamming_index.nearest(read(spark, root, "embeddings"), F.col("id") % 20 == 0)
