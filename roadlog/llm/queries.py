"""The registered queries of the operators, each with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlog.llm import (
    bpe,
    exact_dedup,
    fingerprints,
    line_dedup,
    minhash,
    mixing,
    perspectives,
    pii,
    quality,
    repair,
    secrets,
    sharding,
    treap,
)
from roadlog.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql.strip()
        return fn

    return register


def later_half(id_col: str = "doc_id") -> Column:
    """Which documents count as arrivals; the others are the history they meet."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 1


def default_codec(spark: SparkSession) -> bpe.Codec:
    import public_tokenizers  # only the two queries that encode need its files

    return bpe.Codec(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query()
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encode and decode every text; digests of both."""
    codec = default_codec(spark)
    back = bpe.decode(bpe.encode(table(spark, folder, "documents"), codec), codec)
    return back.select(
        "doc_id",
        bpe.n_tokens("ids").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    """
    WITH t AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
      FROM documents),
    g AS (
      SELECT lowered, max(doc_id) AS keep_id, count(*) AS group_size, sha256(lowered) AS text_sha256
      FROM t GROUP BY lowered)
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
    FROM t JOIN g USING (lowered)
    """
)
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the documents meet the other half; of equal texts the largest id stays."""
    verdict = exact_dedup.deduplicate(table(spark, folder, "documents"), later_half())
    return verdict.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def held_out(id_col: str = "doc_id") -> Column:
    """Documents no classifier learns from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query()
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score for every document, learnt from the labels outside the held-out quarter."""
    docs = table(spark, folder, "documents")
    weights = quality.train(docs, table(spark, folder, "labels"), ~held_out())
    return quality.score(docs, weights).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"),
    )


@query()
def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of near duplicates: three words a shingle, 85 of 100 shingles in common."""
    return minhash.near_duplicates(table(spark, folder, "documents"))


def _span_text(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(
        F.transform(
            spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["finish"])
        ),
        ",",
    )


@query()
def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every text: fixed formats, and runs that pass the randomness battery."""
    found = secrets.scan(table(spark, folder, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < 3)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_span_text(base, secrets.KINDS), 256).alias("base_sha256"),
        _span_text(F.col("spans"), secrets.KINDS).alias("spans"),
        "n_tested",
    )


@query()
def op6_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Sixteen runs of a Hilbert curve through source, language and size, equal in rows."""
    return sharding.assign(table(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


@query(
    """
    WITH said AS (
      SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS role,
        replace(coalesce(text, ''), '<|', '< |') AS text, CAST(floor(turn / 256) AS BIGINT) AS page
      FROM conversations),
    placed AS (
      SELECT *, row_number() OVER (
        PARTITION BY conv_id, page ORDER BY turn NULLS LAST, role, text) AS place
      FROM said),
    speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role <> 'system'),
    segments AS (
      SELECT p.conv_id, speaker, page, CAST((place - 1) // 256 AS INTEGER) AS piece, place,
        role = speaker AS own,
        '<|' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN role
          ELSE 'user name=' || role END || '|>' || chr(10) AS head,
        text || '<|end|>' || chr(10) AS body
      FROM placed p JOIN speakers s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
    ends AS (
      SELECT *, sum(length(head) + length(body)) OVER (
        PARTITION BY conv_id, speaker, page, piece ORDER BY place) AS upto
      FROM segments)
    SELECT conv_id, speaker, page, piece, count(*) AS n_turns,
      string_agg(head || body, '' ORDER BY place) AS text,
      coalesce(string_agg(CAST(upto - length(body) AS BIGINT) || ':' || CAST(upto - 1 AS BIGINT), ',' ORDER BY place)
        FILTER (WHERE own), '') AS mask
    FROM ends GROUP BY conv_id, speaker, page, piece
    """
)
def op8_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation from the side of each of its speakers."""
    rendered = perspectives.render(table(spark, folder, "conversations"))
    mask = F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["finish"]))
    return rendered.withColumn("mask", F.array_join(mask, ","))


def mix_levels() -> list[mixing.Level]:
    """Domains are groups of sources by their number; weights fall from domain to
    domain and favour English."""
    # the last two digits tell the remainder by four
    number = F.nullif(F.regexp_extract("source", "[0-9]{1,2}$", 0), F.lit(""))
    domain = F.concat(F.lit("domain"), F.coalesce(number.cast("int") % 4, F.lit(-1)))
    return [
        mixing.Level("domain", domain, 5 - F.substring("domain", -1, 1).cast("int")),
        mixing.Level("lang", F.col("lang"), F.when(F.col("lang") == "en", 4).otherwise(2)),
        mixing.Level("source", F.col("source"), F.lit(1)),
    ]


def _dealt(children: str, name: str, parent: str) -> str:
    """SQL that deals ``budget`` among the children of a parent by ``weight``, at most ``most``."""
    siblings = f"PARTITION BY {parent}" if parent else ""
    return f"""
      SELECT *, CASE WHEN full_ THEN most ELSE least(most,
        CAST(CAST(weight AS HUGEINT) * (budget - coalesce(sum(most) FILTER (WHERE full_) OVER ({siblings}), 0))
          // sum(weight) FILTER (WHERE NOT full_) OVER ({siblings}) AS BIGINT)) END AS given
      FROM (
        SELECT *, coalesce(rank < min(rank) FILTER (WHERE NOT reaches) OVER ({siblings}), true) AS full_
        FROM (
          SELECT *, most * rest <= CAST(weight AS HUGEINT) * (budget - before) AS reaches
          FROM (
            SELECT *, row_number() OVER w AS rank,
              coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
              sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
            FROM ({children})
            WINDOW w AS ({siblings} ORDER BY most / weight, {name}))))"""


@query(
    f"""
    WITH rows_ AS (
      SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
        coalesce('domain' || coalesce(CAST(nullif(regexp_extract(source, '[0-9]{{1,2}}$'), '') AS INTEGER) % 4, -1), '')
          AS domain,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS tokens, md5(coalesce(text, '')) AS text_key
      FROM documents),
    leaves AS (
      SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM rows_ GROUP BY ALL),
    d AS ({_dealt("""SELECT domain, CAST(sum(tokens) * 3 AS BIGINT) AS most,
        5 - CAST(right(domain, 1) AS INTEGER) AS weight,
        least((SELECT CAST(sum(tokens) AS BIGINT) // 2 FROM leaves),
          (SELECT CAST(sum(tokens) * 3 AS BIGINT) FROM leaves)) AS budget
        FROM leaves GROUP BY domain""", "domain", "")}),
    l AS ({_dealt("""SELECT x.domain, x.lang, x.most, CASE WHEN x.lang = 'en' THEN 4 ELSE 2 END AS weight,
        d.given AS budget
        FROM (SELECT domain, lang, CAST(sum(tokens) * 3 AS BIGINT) AS most FROM leaves GROUP BY domain, lang) x
        JOIN d USING (domain)""", "lang", "domain")}),
    s AS ({_dealt("""SELECT x.domain, x.lang, x.source, x.tokens, x.tokens * 3 AS most, 1 AS weight,
        l.given AS budget FROM leaves x JOIN l USING (domain, lang)""", "source", "domain, lang")}),
    placed AS (
      SELECT r.*, CASE WHEN s.tokens = 0 THEN 0 ELSE given // s.tokens END AS passes,
        CASE WHEN s.tokens = 0 THEN 0 ELSE given % s.tokens END AS prefix
      FROM rows_ r JOIN s USING (domain, lang, source)),
    summed AS (
      SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source
        ORDER BY md5('7/' || passes || '/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || text_key), doc_id) AS upto
      FROM placed)
    SELECT doc_id, domain, lang, source, tokens,
      CAST(passes + CASE WHEN prefix > 0 AND upto <= prefix THEN 1 ELSE 0 END AS BIGINT) AS copies
    FROM summed
    """
)
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Half of all tokens, dealt through domain, language and source."""
    return mixing.mix(table(spark, folder, "documents"), mix_levels()).drop("text_key")


@query()
def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Subtractable fingerprints of every text and of its edited version."""
    found = fingerprints.compared(fingerprints.versions(table(spark, folder, "documents")))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


@query()
def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every text: fixed formats, and what stands where they stand."""
    found = pii.scan(table(spark, folder, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < 4)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS[:4])],
        F.sha2(_span_text(base, pii.KINDS), 256).alias("base_sha256"),
        _span_text(F.col("spans"), pii.KINDS).alias("spans"),
    )


@query(
    """
    WITH d AS (
      SELECT row_number() OVER () AS row_, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT row_, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
    k AS (
      SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM l),
    shared AS (
      SELECT key, min(doc_id) AS holder FROM k
      WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT row_) > 1),
    marked AS (
      SELECT k.*, holder IS NOT NULL AND k.doc_id <> holder AS dropped FROM k LEFT JOIN shared USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY row_, doc_id
    """
)
def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines of ten code points or more that an earlier one has."""
    return line_dedup.dedup_lines(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


@query(
    """
    WITH d AS (
      SELECT row_number() OVER () AS row_, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS terms
      FROM documents),
    sized AS (SELECT row_, doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0),
    total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized),
    asked AS (
      SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term
      FROM benchmark),
    questions AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
    said AS (SELECT row_, doc_id, n, unnest(terms) AS term FROM sized),
    counts AS (
      SELECT row_, doc_id, n, term, count(*) AS tf FROM said
      WHERE term IN (SELECT term FROM questions) GROUP BY ALL),
    weights AS (
      SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), total),
    impacts AS (
      SELECT row_, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)) AS impact
      FROM counts, total),
    scores AS (
      SELECT item_id, row_, doc_id, CAST(sum(times * w * impact) AS BIGINT) AS score
      FROM questions JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """
)
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    asked = treap.questions(table(spark, folder, "benchmark"))
    index = treap.index(table(spark, folder, "documents"), asked.select("term").distinct())
    return treap.search(index, asked).select(F.col("id").alias("item_id"), "rank", "doc_id", "score")


# 2 ** 32 - 1, the polynomial of CRC-32, and the DP by hand: b0 to b3 are the costs behind a
# row from the states start, after system, after user, after assistant; c0 to c3 before it
_REPAIR_SQL = """
    WITH RECURSIVE
    crc_table AS (
      SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
          lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
        FROM range(256) AS r(i))),
    kinds AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(
          list_prepend(4294967295, list_transform(
            string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
            lambda x: CAST(ord(x) AS BIGINT))),
          lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1])), 4294967295) % 20 AS kind
      FROM conversations, crc_table),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM kinds WHERE kind <> 0),
    placed AS (
      SELECT *, left(role, 1) AS i, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
        trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said
      FROM damaged),
    marked AS (
      SELECT *, CASE WHEN said = '' THEN 'blank'
          WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
          WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(i) OVER (PARTITION BY conv_id ORDER BY k) AS i_before,
        count(*) OVER (PARTITION BY conv_id) AS n
      FROM placed),
    asked AS (
      SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS x
      FROM marked),
    back AS (
      SELECT DISTINCT conv_id, n + 1 AS k, 0 AS c0, 10 AS c1, 5 AS c2, 0 AS c3,
        '' AS e0, '' AS e1, '' AS e2, '' AS e3 FROM asked
      UNION ALL
      SELECT conv_id, k, f0, f1, f2, f3,
        CASE WHEN 2 + b0 = f0 THEN 'D' WHEN 5 + f2 = f0 THEN 'I' WHEN k0 = f0 THEN 'K' ELSE 'R' END,
        CASE WHEN 2 + b1 = f1 THEN 'D' WHEN 5 + f2 = f1 THEN 'I' WHEN k1 = f1 THEN 'K' ELSE 'R' END,
        CASE WHEN 2 + b2 = f2 THEN 'D' WHEN 5 + f3 = f2 THEN 'I' WHEN k2 = f2 THEN 'K' ELSE 'R' END,
        CASE WHEN 2 + b3 = f3 THEN 'D' WHEN 5 + f2 = f3 THEN 'I' WHEN k1 = f3 THEN 'K' ELSE 'R' END
      FROM (
        SELECT *, least(d0, 5 + least(d2, 5 + d3)) AS f0, least(d1, 5 + least(d2, 5 + d3)) AS f1,
          least(d2, 5 + d3) AS f2, least(d3, 5 + d2) AS f3
        FROM (
          SELECT *, least(2 + b0, k0, x + 1 + b2) AS d0, least(2 + b1, k1, x + 1 + b2) AS d1,
            least(2 + b2, k2, x + 1 + b3) AS d2, least(2 + b3, k1, x + 1 + b2) AS d3
          FROM (
            SELECT a.conv_id, a.k, a.x, c0 AS b0, c1 AS b1, c2 AS b2, c3 AS b3,
              x + CASE i WHEN 's' THEN c1 WHEN 'u' THEN c2 ELSE 1000000000 END AS k0,
              x + CASE i WHEN 'u' THEN c2 ELSE 1000000000 END AS k1,
              x + CASE i WHEN 'a' THEN c3 ELSE 1000000000 END AS k2
            FROM back JOIN asked a ON a.conv_id IS NOT DISTINCT FROM back.conv_id AND a.k = back.k - 1)))),
    forth AS (
      SELECT DISTINCT conv_id, CAST(1 AS BIGINT) AS k, 0 AS q, '' AS audit, CAST([] AS VARCHAR[]) AS kept FROM asked
      UNION ALL
      SELECT conv_id, CASE WHEN e = 'I' THEN k ELSE k + 1 END,
        CASE WHEN e = 'D' THEN q WHEN e = 'K' AND i = 's' THEN 1 WHEN q = 2 THEN 3 ELSE 2 END,
        audit || e,
        CASE e WHEN 'D' THEN kept WHEN 'K' THEN list_append(kept, role || ':' || text)
          WHEN 'I' THEN list_append(kept, made || ':') ELSE list_append(kept, made || ':' || text) END
      FROM (
        SELECT f.conv_id, f.k, f.q, f.audit, f.kept, a.i, a.role, a.text,
          CASE f.q WHEN 0 THEN b.e0 WHEN 1 THEN b.e1 WHEN 2 THEN b.e2 ELSE b.e3 END AS e,
          CASE WHEN f.q = 2 THEN 'assistant' ELSE 'user' END AS made
        FROM forth f JOIN asked a ON a.conv_id IS NOT DISTINCT FROM f.conv_id AND a.k = f.k
        JOIN back b ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND b.k = f.k)),
    totals AS (
      SELECT conv_id, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
        count(*) FILTER (WHERE fault = 'truncated') AS truncated,
        count(*) FILTER (WHERE k > 1 AND i_before || i NOT IN ('su', 'ua', 'au')) AS illegal
      FROM marked GROUP BY conv_id),
    repaired AS (
      SELECT t.*, b.c0 AS cost, f.audit || CASE f.q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
        sha256(array_to_string(list_concat(f.kept,
          CASE f.q WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END), chr(10))) AS repaired_sha256
      FROM totals t JOIN forth f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.k = t.n + 1
      JOIN back b ON b.conv_id IS NOT DISTINCT FROM t.conv_id AND b.k = 1)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
      coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
    """


@query(_REPAIR_SQL)
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation after planted faults: what is wrong, and the cheapest repair."""
    given = table(spark, folder, "conversations")
    found = repair.repair(repair.damaged(given))
    names = given.select("conv_id").distinct().withColumn("conv_key", repair.conv_key(F.col("conv_id")))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        names.join(found.report, "conv_key", "left")
        .join(repair.digests(found.rows), "conv_key", "left")
        .select(
            "conv_id",
            *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )
