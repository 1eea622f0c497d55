"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.bpe import with_bpe_digests
from corpusloom.llm.chat import format_conversations, read_back
from corpusloom.llm.classifier import classify
from corpusloom.llm.common import documents
from corpusloom.llm.conversation_repair import conversation_reports
from corpusloom.llm.line_dedup import without_repeated_lines
from corpusloom.llm.mixing import mix_sources
from corpusloom.llm.near_dedup import near_duplicates
from corpusloom.llm.quality_rules import apply_host_rules, with_rule_counts
from corpusloom.llm.spotsigs import with_edited_text
from corpusloom.llm.suffix_dedup import without_repeats
from corpusloom.llm.suffix_tree import score_texts
from corpusloom.llm.token_counts import count_tokens
from corpusloom.llm.vector_codes import compress_vectors
from corpusloom.runtime import checkpoint


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


TRICKY = "\\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    added = spark.createDataFrame(tricky, "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(turns.unionByName(added)))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    counted = count_tokens(docs, tokenizer_path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"), words=2, percent=80)


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edited_text(documents(spark, sf_dir, "doc_id", "text")).drop("text")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(documents(spark, sf_dir, "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    coded = with_bpe_digests(docs, tokenizer_path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2
    return score_texts(documents(spark, sf_dir, "doc_id", "text"), learn)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = classify(documents(spark, sf_dir), labels)
    return scored.select("doc_id", "quality_score", "content_score", "metadata_score", "accepted")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_repeats(documents(spark, sf_dir, "doc_id", "text"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = with_rule_counts(documents(spark, sf_dir, "doc_id", "text", "source"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = apply_host_rules(checkpoint(counted.drop("text")))
    return judged.select("doc_id", *counts, "base_failed", "kept", F.round("host_rate", 6).alias("host_rate"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of smaller id holds too."""
    cleaned = without_repeated_lines(documents(spark, sf_dir, "doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part codes of all usable vectors, their errors and the digest of the codebooks."""
    coded = compress_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired rows of every damaged conversation."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_reports(turns.select("conv_id", "turn", "role", "text"))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_spotsigs": op4_spotsigs,
    "op5_mix_sources": op5_mix_sources,
    "op7_lm_scores": op7_lm_scores,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op6_bpe_round_trip": op6_bpe_round_trip,
    "op11_line_dedup": op11_line_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_conversation_repair": op13_conversation_repair,
}

_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_NEAR_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS ws FROM documents),
shingles AS (
  SELECT doc_id, CASE WHEN len(ws) < 2 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh FROM words WHERE len(ws) > 0),
flat AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS s FROM shingles),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM flat a JOIN flat b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT d.doc_id, coalesce(len(sh), 0)::BIGINT AS n_shingles, min(v) AS component_id, min(v) = d.doc_id AS kept
FROM documents d LEFT JOIN shingles USING (doc_id) JOIN reach ON d.doc_id = u GROUP BY d.doc_id, sh
"""

_MIX_SQL = f"""
WITH sized AS (SELECT doc_id, source, len({_WORDS.format(text="coalesce(text, '')")})::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
weighted AS (SELECT *, [3, 1, 2][place % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS bound FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(bound) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted WINDOW o AS (ORDER BY bound / weight, place)),
targets AS (
  SELECT source, source_size, place, least(bound, coalesce(weight * max(CASE WHEN level * weight <= bound THEN level END) OVER (), bound)) AS target FROM levels),
planned AS (
  SELECT *, floor(target)::BIGINT AS words, (source_size + 127) // 128 AS blocks,
    CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS loops FROM targets),
needs AS (SELECT *, loops * blocks + (words - loops * source_size + 127) // 128 AS needed FROM planned),
counts AS (SELECT (sum(words)::BIGINT + 127) // 128 AS slots, count(*) AS places FROM needs),
shares AS (SELECT place, sum(words) OVER (ORDER BY place) / sum(words) OVER () AS high, words, sum(words) OVER () AS total FROM needs),
bounds AS (SELECT place, coalesce(lag(high) OVER (ORDER BY place), 0.0) AS low, high FROM shares),
points AS (
  SELECT id, list_sum([((id >> i) & 1) << (39 - i) FOR i IN range(40)]) / 1099511627776.0::DOUBLE AS point
  FROM (SELECT unnest(range(slots)) AS id FROM counts)),
owned AS (
  SELECT place, id, row_number() OVER (PARTITION BY place ORDER BY id) - 1 AS rank
  FROM points JOIN bounds ON point >= low AND point < high),
made AS (SELECT place, coalesce(max(rank) + 1, 0) AS made FROM needs LEFT JOIN owned USING (place) GROUP BY place),
closers AS (SELECT place, unnest(range(made, needed)) AS rank FROM needs JOIN made USING (place)),
scheduled AS (
  SELECT place, rank, id FROM owned UNION ALL SELECT place, rank, slots + rank * places + place FROM closers, counts),
placed AS (
  SELECT s.*, t.source_size, t.target, t.words, t.place, t.loops,
    sum(size) OVER (PARTITION BY s.source ORDER BY md5('mix:' || doc_id), size)::BIGINT - size AS start
  FROM sized s JOIN needs t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT *, (CASE WHEN size = 0 THEN 0 ELSE loops * size + greatest(least(words - loops * source_size - start, size), 0) END)::BIGINT AS taken
  FROM placed)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN id END AS first_slot
FROM mixed LEFT JOIN scheduled ON scheduled.place = mixed.place AND scheduled.rank = start // 128
"""

_REPEATS_SQL = """
WITH data AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, (length(h) / 2)::BIGINT AS n FROM documents),
bytes AS (
  SELECT doc_id, pos, substr(h, 2 * pos + 1, 2) AS byte, CASE WHEN pos + 100 <= n THEN md5(substr(h, 2 * pos + 1, 200)) END AS w
  FROM (SELECT doc_id, h, n, unnest(range(0, n)) AS pos FROM data)),
marked AS (
  SELECT doc_id, pos, byte, w IS NOT NULL AND row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) > 1 AS again FROM bytes),
covered AS (
  SELECT *, max(again::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) = 1 AS gone FROM marked),
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM covered),
cut AS (
  SELECT doc_id, count(*) FILTER (gone) AS removed, count(*) FILTER (opens) AS spans,
    coalesce(string_agg(byte, '' ORDER BY pos) FILTER (NOT gone), '') AS kept FROM edges GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM data LEFT JOIN cut USING (doc_id)
"""

_RULES_SQL = f"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
windows AS (SELECT doc_id, i, ws[i:i + 4] AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM texts)),
often AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM often, range(5) AS r(k) GROUP BY doc_id),
counts AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM texts)
  LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
hosts AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM judged GROUP BY source),
prior AS (
  SELECT m, seen - chance AS excess FROM (
    SELECT any_value(m) AS m, sum(n * (f / n - m) * (f / n - m)) / sum(n) AS seen, count(*) * any_value(m) * (1 - any_value(m)) / sum(n) AS chance
    FROM hosts, (SELECT sum(f) / sum(n) AS m FROM hosts))),
rated AS (
  SELECT source, CASE WHEN excess > 0 THEN (f + greatest(m * (1 - m) / excess - 1, 1) * m) / (n + greatest(m * (1 - m) / excess - 1, 1)) ELSE m END AS rate
  FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rate <= 0.5 AS kept, round(rate, 6) AS host_rate
FROM judged j JOIN rated r ON j.source IS NOT DISTINCT FROM r.source
"""

_LINES_SQL = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT doc_id, i, ls[i] AS line, translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k
  FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM split)),
firsts AS (SELECT k, min(doc_id) AS first FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
judged AS (SELECT doc_id, i, line, coalesce(doc_id > first, false) AS gone FROM lines LEFT JOIN firsts USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _codes_round(n: int) -> str:
    """Nearest entries of codebook n."""
    square = "list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    return f"near{n} AS (SELECT r, p, min({square} * 64 + e) AS m FROM parts JOIN book{n} USING (p) GROUP BY r, p)"


def _codes_book(n: int) -> str:
    """Codebook n + 1 from the parts assigned to codebook n."""
    return f"""
sums{n} AS (
  SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS y FROM (
    SELECT p, (m % 64)::BIGINT AS e, i, sum(x[i])::BIGINT AS s, count(*)::BIGINT AS n
    FROM near{n} JOIN parts USING (r, p), range(1, (SELECT any_value(len(x)) FROM parts) + 1) AS c(i) GROUP BY p, m % 64, i) GROUP BY p, e),
book{n + 1} AS (SELECT b.p, b.e, coalesce(s.y, b.y) AS y FROM book{n} b LEFT JOIN sums{n} s ON b.p = s.p AND b.e = s.e)"""


_CODES_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v, len(embedding) // 16 AS w
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT r, p, v[p * w + 1:p * w + w] AS x FROM kept, range(16) AS t(p)),
book0 AS (SELECT p, r - 1 AS e, x AS y FROM parts WHERE r <= 64),
{_codes_round(0)},{_codes_book(0)},
{_codes_round(1)},{_codes_book(1)},
{_codes_round(2)},
books AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2),
coded AS (SELECT r, string_agg(printf('%02x', (m % 64)::BIGINT), '' ORDER BY p) AS code, sum(m // 64)::BIGINT AS error FROM near2 GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (r), books
"""


def _edit(way: str, cost: str, letter: str, line: str = "''") -> str:
    """A way of repair (six digits of cost, edits, mark, lines) with one edit more."""
    mark = f"strpos({way}, chr(1))"
    return f"printf('%06d', substr({way}, 1, 6)::INT + {cost}) || substr({way}, 7, {mark} - 7) || '{letter}' || substr({way}, {mark}) || {line}"


def _inserted(table: str) -> str:
    """Ways to the four states where rows may be inserted next."""
    user, reply = (_edit("{}", "2", "I", f"chr(10) || '{role}:'") for role in ("user", "assistant"))
    return f"""(
  SELECT * REPLACE (least(w2, {user.format(*["w3"] * 5)}) AS w2) FROM (
  SELECT * REPLACE (least(w3, {reply.format(*["w2"] * 5)}) AS w3) FROM (
  SELECT * REPLACE (least(w2, {user.format(*["w0"] * 5)}, {user.format(*["w1"] * 5)}, {user.format(*["w3"] * 5)}) AS w2) FROM {table})))"""


def _taken(state: int) -> str:
    """Least way to a state by keeping or reroling a row."""
    own = "chr(10) || role || ':' || text"
    role = "assistant" if state == 3 else "user"
    origins = {1: ["w0"], 2: ["w0", "w1", "w3"], 3: ["w2"]}[state]
    ways = [_edit(f"w{state}", "3", "D")]
    for way in origins:
        ways.append(f"CASE WHEN NOT must AND initial = '{' sua'[state]}' THEN {_edit(way, 'cut', 'K', own)} END")
        if state > 1:
            ways.append(f"CASE WHEN NOT must THEN {_edit(way, '2 + cut', 'R', f"chr(10) || '{role}:' || text")} END")
    return f"least({', '.join(ways)})"


_REPAIR_SQL = f"""
WITH RECURSIVE crcs AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT) AS b
  FROM conversations),
fates AS (
  SELECT * EXCLUDE (b, t), xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS fate
  FROM keyed, crcs),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM fates WHERE fate <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed),
checked AS (
  SELECT *, bare = '' AS is_blank, bare <> '' AND again AS is_repeat, bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS is_cut,
    bare = '' OR again AS must, (bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?'))::INT AS cut,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM faulty),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, '000000' || chr(1) AS w0, NULL::VARCHAR AS w1, NULL::VARCHAR AS w2, NULL::VARCHAR AS w3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT s.conv_id, r.i, {_edit("w0", "3", "D")} AS w0, {_taken(1)} AS w1, {_taken(2)} AS w2, {_taken(3)} AS w3
  FROM {_inserted("steps")} AS s JOIN checked r ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = s.i + 1),
ends AS (
  SELECT conv_id, least(w0, w3) AS way FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM {_inserted("steps")}) WHERE back = 1),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (is_blank) AS blank,
    count(*) FILTER (is_repeat) AS duplicate, count(*) FILTER (is_cut) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM checked GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, substr(way, 1, 6)::BIGINT AS cost,
  substr(way, 7, strpos(way, chr(1)) - 7) AS audit, sha256(substr(way, strpos(way, chr(1)) + 2)) AS repaired_sha256
FROM ends e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

# The other operators have no SQL twin: library tokenizers, models learnt here, Spark's hashes.
ORACLES: dict[str, str] = {
    "op3_near_duplicates": _NEAR_SQL,
    "op5_mix_sources": _MIX_SQL,
    "op9_suffix_dedup": _REPEATS_SQL,
    "op10_quality_rules": _RULES_SQL,
    "op11_line_dedup": _LINES_SQL,
    "op12_vector_codes": _CODES_SQL,
    "op13_conversation_repair": _REPAIR_SQL,
}
