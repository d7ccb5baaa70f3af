"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trendlens.llm import (chat, decontaminate, lines, minhash, periods, pieces, quality, repair, secrets, simhash,
                           suffix, tokens, urls)
from trendlens.llm.common import read

# Fixed value: the added conversation -1 says this in both turns.
PROBE = "</s>[INST] ok [/INST]"


def op1_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix.remove_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["stop"] - x["start"])
    return left.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"),
                               F.lit(role).alias("role"), F.lit(PROBE).alias("text")) for i, role in enumerate(("user", "assistant"))])
    log = chat.log_of_rows(rows.unionByName(spark.range(1).select(F.inline(probe))))
    return chat.digest(chat.read_back(chat.render(chat.fold(log))))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(read(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("broken_rules", ",").alias("broken_rules"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(read(spark, sf_dir, "documents").select("doc_id", "text"),
                               read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict")


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat, manifest = tokens.write_files(read(spark, sf_dir, "documents"))
    return tokens.scan(flat).filter("closed").join(manifest, ["file", "ordinal"]).select("doc_id", "n_tokens")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest(secrets.scan(docs, secrets.train(docs)))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.Model.load()
    back = pieces.encode(read(spark, sf_dir, "documents"), model, round_trip=True)
    return back.select(
        "doc_id", F.size(F.coalesce("pieces", F.array())).cast("long").alias("n_pieces"),
        F.sha2(F.array_join(F.col("pieces").cast("array<string>"), ","), 256).alias("pieces_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
        F.sha2("text", 256).eqNullSafe(F.col("text_sha256")).alias("round_trip"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.cluster(read(spark, sf_dir, "documents")).select(
        "doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", periods.planted().alias("text"))
    found = periods.find(docs).withColumn("best", periods.greatest())
    listed = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    lines_of_runs = F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *(F.col("best").getField(c).alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines_of_runs, 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    judged = repair.judge(repair.damaged(rows))
    planned = repair.plans(judged)
    out = rows.select("conv_id").distinct().alias("c")
    for table in (repair.summary(judged), planned, repair.digests(repair.repaired(judged, planned))):
        t = table.withColumnRenamed("conv_id", "id").alias("t")
        out = out.join(t, F.col("c.conv_id").eqNullSafe(F.col("t.id")), "left").drop("id").alias("c")
    return out.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c)
                     for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES = {
    "op1_suffix": op1_suffix,
    "op2_chat": op2_chat,
    "op3_minhash": op3_minhash,
    "op4_quality": op4_quality,
    "op5_decontaminate": op5_decontaminate,
    "op6_lines": op6_lines,
    "op7_urls": op7_urls,
    "op8_tokens": op8_tokens,
    "op9_secrets": op9_secrets,
    "op10_pieces": op10_pieces,
    "op11_simhash": op11_simhash,
    "op12_periods": op12_periods,
    "op13_repair": op13_repair,
}

ORACLE = {
    "op2_chat": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS body,
    replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\n>') AS head FROM c),
g AS (SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length(head) + length(body) + length('<|start|>') + length('<|end|>') + 2) AS chars
    FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
    CAST(chars AS BIGINT) AS formatted_chars FROM g
""",
    "op4_quality": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
tri AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS t
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tri) WHERE c > 1),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(hit.n, 0) AS n_repeat_words,
    len(list_intersect(list_distinct(list_transform(words, lambda x: lower(x))), [{stops}])) AS n_stop,
    (len(regexp_extract_all(text, '!!\s')) + CASE WHEN text LIKE '%!!' THEN 1 ELSE 0 END) AS n_excl,
    len(list_filter(lines, lambda x: x LIKE '%...' OR x LIKE '%…')) AS n_ell,
    len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS n_bul
    FROM w LEFT JOIN hit USING (doc_id)),
r AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_len,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS sym,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup,
    CASE WHEN n_lines > 0 THEN n_ell / n_lines ELSE 0 END AS ell,
    CASE WHEN n_lines > 0 THEN n_bul / n_lines ELSE 0 END AS bul,
    CASE WHEN n_words > 0 THEN n_excl / n_words ELSE 0 END AS excl FROM m),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    concat_ws(',',
    CASE WHEN n_words < 50 THEN 'length' END,
    CASE WHEN mean_len < 2 OR mean_len > 12 THEN 'mean_word_length' END,
    CASE WHEN sym > 0.1 THEN 'symbol_ratio' END,
    CASE WHEN n_stop < 2 THEN 'stop_words' END,
    CASE WHEN dup > 0.5 THEN 'duplicate_lines' END,
    CASE WHEN ell > 0.3 THEN 'ellipsis_lines' END,
    CASE WHEN bul > 0.9 THEN 'bullet_lines' END,
    CASE WHEN excl > 0.2 THEN 'exclaimed_words' END) AS broken_rules FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND broken_rules = '' AS kept, broken_rules FROM j
""".replace("{stops}", ", ".join(f"'{w}'" for w in sorted({w for row in quality.STOP_WORDS for w in row.split()}))),
    "op5_decontaminate": r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM
    (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM
    (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM t, (SELECT DISTINCT n FROM bw))),
h AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw USING (n, g)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
SELECT t.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM t LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
""",
    "op7_urls": r"""
WITH u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '^.*?://([^?#]*)', 1, 's') AS rest FROM pages),
p AS (SELECT page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    AS host, substr(rest, length(split_part(rest, '/', 1)) + 1) AS path FROM u),
r AS (SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) v(rh, rp, rv)),
f AS (SELECT page_id, rh || rp AS rule, rv, row_number() OVER
    (PARTITION BY page_id ORDER BY length(rh || rp) DESC, rv DESC) AS k
    FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
b AS (SELECT l || '.example.' || t AS bh FROM (SELECT unnest([{labels}]) AS l), (SELECT unnest(['com', 'net', 'org']) AS t)),
x AS (SELECT DISTINCT page_id FROM p JOIN b ON host = bh OR ends_with(host, '.' || bh))
SELECT p.page_id, host, path, rule, coalesce(rv, CASE WHEN x.page_id IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN (SELECT * FROM f WHERE k = 1) f USING (page_id) LEFT JOIN x ON p.page_id = x.page_id
""".replace("{labels}", ", ".join(f"'{x}'" for x in urls.BLOCKED_LABELS)),
    "op6_lines": r"""
WITH d AS (SELECT doc_id, source, text, coalesce(source, '') AS host,
    string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT host, unnest(list_distinct(list_filter(lines, lambda x: NOT regexp_matches(x, '^\s*$')))) AS line FROM d),
b AS (SELECT host, list(line) AS bad FROM (SELECT host, line, count(*) AS n FROM l GROUP BY ALL)
    JOIN (SELECT host, count(*) AS pages FROM d GROUP BY 1) USING (host)
    WHERE n > 0.05 * pages AND (n >= 10 OR n >= 2 AND n > 0.8 * pages) GROUP BY host),
k AS (SELECT d.*, list_filter(lines, lambda x: regexp_matches(x, '^\s*$') OR NOT list_contains(coalesce(bad, []), x))
    AS kept FROM d LEFT JOIN b USING (host))
SELECT doc_id, source, CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text,
    len(list_filter(lines, lambda x: NOT regexp_matches(x, '^\s*$'))) AS n_lines,
    len(lines) - len(kept) AS n_dropped FROM k
""",
    "op13_repair": r"""
WITH crc AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1)
    ELSE c >> 1 END, i) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(string_split(
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
    lambda x: CAST(ascii(x) AS BIGINT)) AS key FROM conversations),
hashed AS (SELECT conv_id, turn, role, text, xor(list_reduce(key, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8),
    4294967295), 4294967295) % 20 AS kind FROM given, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN ''
    WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hashed WHERE kind <> 0),
placed AS (SELECT *, left(role, 1) AS head, row_number() OVER w AS n, lag(left(role, 1)) OVER w AS before FROM damaged
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM placed),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before || head NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
moves AS (SELECT conv_id, n, k, head, role || ':' || text AS line, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000
    WHEN fault = 'truncated' THEN 5 ELSE 0 END AS price, role, text FROM judged, (SELECT unnest([0, 1]) AS k)
    UNION ALL SELECT conv_id, max(n) + 1, 0, '', '', 0, '', '' FROM judged GROUP BY conv_id),
folded AS (SELECT conv_id, list_reduce(list({'k': k, 'head': head, 'line': line, 'price': price, 'text': text} ORDER BY n, k),
    lambda s, x: CASE WHEN x.k = 0 THEN {insert} ELSE {row} END, {start}) AS s FROM moves GROUP BY conv_id),
ended AS (SELECT conv_id, list_min([s.e, s.a]) AS b FROM folded)
SELECT id AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost,
    coalesce(b.audit, '') AS audit, sha256(coalesce(substr(b.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id AS id FROM conversations) i LEFT JOIN counts ON id IS NOT DISTINCT FROM counts.conv_id
    LEFT JOIN ended ON id IS NOT DISTINCT FROM ended.conv_id
""",
}


def _repair_moves() -> dict[str, str]:
    """The fold of op13's SQL: the best (cost, audit, lines) for each state of the
    grammar (e: nothing, o: after s, u, a), before each row with one insert or none."""
    def way(state: str, edit: str, cost: str, line: str | None = None) -> str:
        lines = f"s.{state}.lines" + (f" || chr(10) || {line}" if line else "")
        return f"{{'cost': s.{state}.cost + {cost}, 'audit': s.{state}.audit || '{edit}', 'lines': {lines}}}"

    def keep(state: str, head: str) -> str:
        return way(state, "K", f"x.price + CASE WHEN x.head = '{head}' THEN 0 ELSE 1000000 END", "x.line")

    def role(state: str, name: str) -> str:
        return way(state, "R", "x.price + 1", f"'{name}:' || x.text")

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def states(e: str, o: str, u: str, a: str) -> str:
        return f"{{'e': {e}, 'o': {o}, 'u': {u}, 'a': {a}}}"

    none = "{'cost': 1000000, 'audit': '', 'lines': ''}"
    return {
        "{insert}": states("s.e", "s.o", least("s.u", *(way(t, "I", "5", "'user:'") for t in "eoa")),
                           least("s.a", way("u", "I", "5", "'assistant:'"))),
        "{row}": states(way("e", "D", "2"), least(way("o", "D", "2"), keep("e", "s")),
                        least(way("u", "D", "2"), *(f(t, n) for t in "eoa" for f, n in ((keep, "u"), (role, "user")))),
                        least(way("a", "D", "2"), keep("u", "a"), role("u", "assistant"))),
        "{start}": states("{'cost': 0, 'audit': '', 'lines': ''}", none, none, none),
    }


for _name, _sql in _repair_moves().items():
    ORACLE["op13_repair"] = ORACLE["op13_repair"].replace(_name, _sql)
