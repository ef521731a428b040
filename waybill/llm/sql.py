"""Checking SQL of the text operators, and what it is made of."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The table of CRC-32 from its polynomial, as one row with a list.
CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc_row)"""


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes; ``crc_row`` must be in scope."""
    byte = f"('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT"
    bytes_ = f"list_transform(range(octet_length(encode({text}))), lambda i: {byte})"
    return f"xor(list_reduce([4294967295] || {bytes_}, lambda x, y: xor(x >> 8, crc_row[xor(x & 255, y) + 1])), 4294967295)"


def lower_ascii(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _grams(words: str) -> str:
    """Runs of one to three words of a table (key, w)."""
    at = lambda n: "list_transform(range(1, len(w) - {}), lambda i: {})".format(
        n - 2, " || ' ' || ".join(f"w[i + {k}]" if k else "w[i]" for k in range(n))
    )
    return f"SELECT key, unnest({at(1)} || {at(2)} || {at(3)}) AS gram FROM {words}"


IMPORTANCE = f"""WITH {CRC_TABLE}, dw AS (
  SELECT doc_id AS key, regexp_extract_all({lower_ascii("coalesce(text, '')")}, '{_WORDS}') AS w FROM documents), tw AS (
  SELECT item_id AS key, regexp_extract_all({lower_ascii("coalesce(text, '')")}, '{_WORDS}') AS w FROM benchmark), dg AS (
  {_grams("dw")}), tg AS ({_grams("tw")}), hashes AS (
  SELECT gram, {crc32("gram")} % 10000 AS bucket FROM (SELECT gram FROM dg UNION SELECT gram FROM tg), crc_table), s AS (
  SELECT bucket, count(*) AS n FROM dg JOIN hashes USING (gram) GROUP BY bucket), t AS (
  SELECT bucket, count(*) AS n FROM tg JOIN hashes USING (gram) GROUP BY bucket), gain AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM dg) + 10000)
    / ((s.n + 1) * ((SELECT count(*) FROM tg) + 10000))))::BIGINT AS g FROM s LEFT JOIN t USING (bucket)), weights AS (
  SELECT key, count(*) AS n, sum(g)::BIGINT AS weight FROM dg JOIN hashes USING (gram) JOIN gain USING (bucket) GROUP BY key), scored AS (
  SELECT dw.key AS doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || dw.key)[1:8])::BIGINT + 0.5::DOUBLE)
      / 4294967296)))::BIGINT AS score
  FROM dw LEFT JOIN weights ON weights.key = dw.key), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE words >= 20), drawn AS (
  SELECT doc_id, place FROM ranked WHERE place <= 5 * (SELECT count(*) FROM ranked) // 100)
SELECT doc_id, n_features, weight, score, place AS rank FROM scored LEFT JOIN drawn USING (doc_id)"""

VARIANTS = rf"""WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, {lower_ascii("run")} AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL), hashed AS (
  SELECT run, n, {crc32("doc_id::VARCHAR || ':' || run")} AS h FROM runs, crc_table), spelled AS (
  SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
    ELSE run END AS word FROM hashed), vocab AS (
  SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2), gaps AS (
  SELECT word, n, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS rest
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM vocab)), pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM vocab a JOIN gaps b ON a.word = b.rest
  UNION SELECT b.word, a.word, a.n FROM vocab a JOIN gaps b ON a.word = b.rest), near AS (
  SELECT word, count(*) AS n_near, max(m) AS top_n FROM pairs GROUP BY word), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 10 * v.n THEN top_n END AS form_n,
    CASE WHEN top_n >= 10 * v.n THEN (SELECT min(p.other) FROM pairs p WHERE p.word = v.word AND p.m = near.top_n) END AS form
  FROM vocab v LEFT JOIN near USING (word)), walk AS (
  SELECT word, word AS root FROM formed
  UNION ALL
  SELECT w.word, f.form FROM walk w JOIN formed f ON f.word = w.root WHERE f.form IS NOT NULL), far AS (
  SELECT w.word, w.root FROM walk w JOIN formed f ON f.word = w.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN far USING (word)"""
