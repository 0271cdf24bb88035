"""The registered queries of this subpackage and the SQL for them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from helmtrack.llm import ann, bpe, chat, divergence, exact_dedup, jaccard, langid, line_dedup, lm_score, packing, periodic, suffix_dedup, toxicity
from helmtrack.llm.common import read

TOKENIZER = "byte_bpe_50k.json"
#: Fixed value: the id that ends a document in a packed sequence.
END_ID = 1


def op1_chat_tool_calls(spark, sf_dir):
    """All turns of all conversations as linked, ordered and validated calls in canonical JSON."""
    return chat.linked_turns(read(spark, sf_dir, "conversations"))


def pipeline(spark, sf_dir):
    """The stages of the corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op2_nnls_packing(spark, sf_dir):
    """All documents cut into pieces of sequences of at most 2048 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID, 2048)


def op3_suffix_dedup(spark, sf_dir):
    """Every document without the 50-byte strings that start in an earlier one, as digests."""
    found = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_bpe_round_trip(spark, sf_dir):
    """Ids of every whole text and the text decoded from them, as digests."""
    return bpe.bpe_round_trip_digest(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_language_codes(spark, sf_dir):
    """The language of every whole text, learned outside the held-out fold."""
    return langid.language_held_out(read(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    """A toxicity score of every whole text, learned outside the held-out fold."""
    return toxicity.toxicity_held_out(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_nn_descent(spark, sf_dir):
    """The 5 nearest vectors of every vector whose identifier is divisible by 50, found in the graph."""
    rows = read(spark, sf_dir, "embeddings")
    return ann.nearest(rows, F.col("vec_id") % 50 == 0, k=5)


def op8_jaccard_join(spark, sf_dir):
    """The component of every document under links of 4-word shingle similarity 0.85 or more."""
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op9_exact_dedup(spark, sf_dir):
    """The group of equal texts of every document, and which one stays."""
    found = exact_dedup.exact_dedup(read(spark, sf_dir, "documents"), keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_backoff_scores(spark, sf_dir):
    """Stupid-backoff scores of every document under counts of all documents; logarithms to 4 places."""
    found = lm_score.lm_scores(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_tokens", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 4).alias("mean_log_score"))


def op11_source_divergence(spark, sf_dir):
    """How far apart the term shares of each two sources of a language are, and each source's own terms."""
    return divergence.source_divergence(read(spark, sf_dir, "documents"))


def op12_line_dedup(spark, sf_dir):
    """Every document without the long lines that five documents or more share, as digests."""
    found = line_dedup.line_dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op13_periodic_runs(spark, sf_dir):
    """The periodic runs of words of every whole text, one in ten of which is tiled first, as digests."""
    return periodic.periodic_run_digest(read(spark, sf_dir, "documents"))


OP10_SQL = """
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), split AS (
  SELECT doc_id, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words FROM lowered
), placed AS (
  SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM split
), paired AS (
  SELECT a.doc_id AS doc_id, a.w AS w, b.w AS h FROM placed a LEFT JOIN placed b ON a.doc_id = b.doc_id AND a.i = b.i + 1
), one AS (
  SELECT w, count(*) AS n FROM placed GROUP BY w
), two AS (
  SELECT h, w, count(*) AS n FROM paired WHERE h IS NOT NULL GROUP BY h, w
), total AS (
  SELECT count(*) AS n FROM placed
), scored AS (
  SELECT p.doc_id AS doc_id,
    ln(CASE WHEN p.h IS NULL THEN CAST(ow.n AS DOUBLE) / t.n
            WHEN two.n >= 2 THEN CAST(two.n AS DOUBLE) / oh.n
            ELSE 0.4 * ow.n / t.n END) AS s
  FROM paired p CROSS JOIN total t JOIN one ow ON p.w = ow.w LEFT JOIN one oh ON p.h = oh.w LEFT JOIN two ON p.h = two.h AND p.w = two.w
), summed AS (
  SELECT doc_id, count(*) AS n, sum(s) AS s FROM scored GROUP BY doc_id
)
SELECT d.doc_id AS doc_id, coalesce(x.n, 0) AS n_tokens, round(coalesce(x.s, 0.0), 4) AS log_score, round(x.s / x.n, 4) AS mean_log_score
FROM documents d LEFT JOIN summed x ON d.doc_id = x.doc_id
"""

OP1_SQL = """
WITH asked AS (
  SELECT conv_id, turn, role, text FROM conversations WHERE role IN ('user', 'system') AND conv_id IS NOT NULL AND turn IS NOT NULL
), turns AS (
  SELECT DISTINCT conv_id, turn FROM asked
), up AS (
  SELECT t.conv_id AS conv_id, t.turn AS turn, coalesce(o.turn, w.turn) AS before
  FROM turns t LEFT JOIN turns o ON t.conv_id = o.conv_id AND t.turn = o.turn + 1 LEFT JOIN turns w ON t.conv_id = w.conv_id AND t.turn = w.turn + 2
), starts AS (
  SELECT conv_id, turn, CASE WHEN before IS NULL THEN 1 ELSE 0 END AS first FROM up
), runs AS (
  SELECT conv_id, turn, sum(first) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM starts
), placed AS (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, run ORDER BY turn) - 1 AS level FROM runs
), calls AS (
  SELECT conv_id, turn, min(CASE WHEN role = 'user' THEN 'reply' ELSE 'configure' END) AS name, count(*) AS n_calls FROM asked GROUP BY conv_id, turn
), arguments AS (
  SELECT c.conv_id AS conv_id, c.turn AS turn, min(a.text) AS text
  FROM calls c JOIN asked a ON c.conv_id = a.conv_id AND c.turn = a.turn AND c.name = CASE WHEN a.role = 'user' THEN 'reply' ELSE 'configure' END GROUP BY c.conv_id, c.turn
), results AS (
  SELECT conv_id, turn - 1 AS turn, min(text) AS content, count(*) AS n_results FROM conversations WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn
), joined AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS turn, c.name AS name, c.n_calls AS n_calls, r.n_results AS n_results, a.text AS text, r.content AS content,
    p.level AS level, u.before AS before,
    CASE WHEN c.name IS NULL THEN NULL ELSE concat_ws('; ',
      CASE WHEN length(a.text) < 1 THEN 'text: too short' END,
      CASE WHEN length(a.text) > CASE WHEN c.name = 'reply' THEN 400 ELSE 300 END THEN 'text: too long' END,
      CASE WHEN a.text IS NULL THEN 'text: missing' END,
      CASE WHEN c.turn < 0 THEN 'turn: too small' END,
      CASE WHEN c.name = 'configure' AND c.turn > 0 THEN 'turn: too large' END) END AS errors
  FROM calls c LEFT JOIN arguments a ON c.conv_id = a.conv_id AND c.turn = a.turn LEFT JOIN placed p ON c.conv_id = p.conv_id AND c.turn = p.turn
  LEFT JOIN up u ON c.conv_id = u.conv_id AND c.turn = u.turn FULL JOIN results r ON c.conv_id = r.conv_id AND c.turn = r.turn
)
SELECT conv_id, 'call_' || turn AS call_id, level,
  CASE WHEN name IS NULL THEN 'orphan' WHEN n_results IS NULL THEN 'pending' WHEN errors <> '' THEN 'invalid' ELSE 'linked' END AS status,
  coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results,
  CASE WHEN coalesce(errors, '') = '' THEN 0 ELSE len(string_split(errors, '; ')) END AS n_errors, errors,
  '{"after":' || coalesce('"call_' || before || '"', 'null')
    || ',"arguments":' || CASE WHEN name IS NULL THEN 'null' WHEN text IS NULL THEN '{"turn":' || turn || '}' ELSE '{"text":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '}' END
    || ',"id":"call_' || turn || '","level":' || coalesce(CAST(level AS VARCHAR), 'null')
    || ',"name":' || coalesce('"' || name || '"', 'null') || ',"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS record
FROM joined
"""

OP9_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (
  SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t
)
SELECT n.doc_id AS doc_id, g.keep_id AS keep_id, g.group_size AS group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""


OP11_SQL = """
WITH rows AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents
), each AS (
  SELECT lang, source, row, unnest(terms) AS term FROM rows
), kept AS (
  SELECT lang, term, count(*) AS n_lang FROM each GROUP BY lang, term HAVING count(DISTINCT row) >= 30
), languages AS (
  SELECT lang, count(*) AS v, sum(n_lang) AS n_all FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM rows
), counts AS (
  SELECT e.lang AS lang, e.source AS source, e.term AS term, count(*) AS n FROM each e JOIN kept k ON e.lang = k.lang AND e.term = k.term GROUP BY e.lang, e.source, e.term
), totals AS (
  SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source
), shares AS (
  SELECT g.lang AS lang, g.source AS source, k.term AS term, coalesce(c.n, 0) AS n,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (coalesce(t.n, 0) + 5 * l.v) AS BIGINT) AS p,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (k.n_lang + 5)) // (l.n_all + 5 * l.v) AS BIGINT) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN languages l ON g.lang = l.lang
  LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term LEFT JOIN totals t ON g.lang = t.lang AND g.source = t.source
), prices AS (
  SELECT a.lang AS lang, a.source AS source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang AS lang, a.source AS source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN prices p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), own AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

OP12_SQL = """
WITH lines AS (
  SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), placed AS (
  SELECT doc_id, row, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM lines
), keyed AS (
  SELECT doc_id, row, place, line, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM placed
), frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.doc_id AS doc_id, k.row AS row, k.place AS place, k.line AS line, f.key IS NOT NULL AND k.doc_id <> f.keeper AS lost FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row
"""


#: The checksum of an identifier bit by bit, then the tiling; runs are islands of words that recur a period further on.
OP13_SQL = """
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, (s & 1) * 3988292384) END), 4294967295) AS h FROM documents
), tiles AS (
  SELECT doc_id, row, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS k FROM texts
), sized AS (
  SELECT doc_id, row, w, n, a, CASE WHEN a IS NOT NULL THEN 1 + (n - a) // k END AS p FROM tiles
), unrolled AS (
  SELECT row, n, a, p, w, unnest(range(n)) AS i FROM sized
), placed AS (
  SELECT row, n, i, w[1 + CASE WHEN a IS NOT NULL AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM unrolled
), again AS (
  SELECT x.row AS row, y.i - x.i AS p, x.i AS i FROM placed x JOIN placed y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), islands AS (
  SELECT row, p, i, i - row_number() OVER (PARTITION BY row, p ORDER BY i) AS island FROM again
), stretches AS (
  SELECT row, p, min(i) AS start, count(*) + p AS length FROM islands GROUP BY row, p, island HAVING count(*) + p >= greatest(24, 3 * p)
), runs AS (
  SELECT row, start, length, min(p) AS period FROM stretches GROUP BY row, start, length
), best AS (
  SELECT row, start, length, period, row_number() OVER (PARTITION BY row ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS place FROM runs
), listed AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM runs GROUP BY row
), lost AS (
  SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
  SELECT x.row AS row, string_agg(x.word, ' ' ORDER BY x.i) AS words FROM placed x LEFT JOIN lost y ON x.row = y.row AND x.i = y.i WHERE y.i IS NULL GROUP BY x.row
)
SELECT t.doc_id AS doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start AS start, b.length AS length, b.period AS period, 1000 * b.length // b.period AS exponent_milli,
  sha256(coalesce(l.runs, '')) AS runs_sha256, sha256(coalesce(c.words, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed l ON t.row = l.row LEFT JOIN best b ON t.row = b.row AND b.place = 1 LEFT JOIN collapsed c ON t.row = c.row
"""


def queries() -> dict:
    found = (op1_chat_tool_calls, op2_nnls_packing, op3_suffix_dedup, op4_bpe_round_trip, op5_language_codes, op6_toxicity, op7_nn_descent, op8_jaccard_join, op9_exact_dedup, op10_backoff_scores, op11_source_divergence, op12_line_dedup, op13_periodic_runs, pipeline)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict:
    return {"op1_chat_tool_calls": OP1_SQL, "op9_exact_dedup": OP9_SQL, "op10_backoff_scores": OP10_SQL, "op11_source_divergence": OP11_SQL, "op12_line_dedup": OP12_SQL, "op13_periodic_runs": OP13_SQL}
