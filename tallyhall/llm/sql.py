"""SQL for the operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from tallyhall.llm import vector_codes as vc

FILL_IN_MIDDLE = """
WITH read AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS b,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS c, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS d
  FROM read),
cut AS (
  SELECT *, array_to_string(units[1:least(a, b)], '') AS prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(units[greatest(a, b) + 1:], '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 90 THEN 'plain'
              WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


def vector_codes() -> str:
    """Rounds of assignment and flooring means, one after another, over rows (vector, part, place, number)."""
    steps = [
        f"""read AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS vector, vec_id, label, embedding,
         len(embedding) // {vc.PARTS} AS width
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
numbers AS MATERIALIZED (
  SELECT vector, (nth - 1) // width AS part, (nth - 1) % width AS place, CAST(floor(CAST(x AS DOUBLE) * {vc.SCALE}) AS BIGINT) AS x
  FROM (SELECT vector, width, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS nth FROM read)),
book0 AS MATERIALIZED (
  SELECT vector - 1 AS entry, part, place, x FROM numbers WHERE vector <= {vc.ENTRIES})"""
    ]
    for r in range(vc.ROUNDS + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (
  SELECT vector, part, min(entry) FILTER (WHERE far = least_far) AS entry, any_value(least_far) AS far
  FROM (SELECT *, min(far) OVER (PARTITION BY vector, part) AS least_far
        FROM (SELECT n.vector, n.part, b.entry, sum((n.x - b.x) * (n.x - b.x)) AS far
              FROM numbers n JOIN book{r} b USING (part, place) GROUP BY ALL))
  GROUP BY vector, part)"""
        )
        if r < vc.ROUNDS:
            steps.append(
                f"""book{r + 1} AS MATERIALIZED (
  SELECT b.entry, b.part, b.place, CAST(coalesce((s - ((s % k) + k) % k) // k, b.x) AS BIGINT) AS x
  FROM book{r} b LEFT JOIN (
    SELECT a.entry, a.part, n.place, sum(n.x) AS s, count(*) AS k
    FROM near{r} a JOIN numbers n USING (vector, part) GROUP BY ALL) USING (entry, part, place))"""
            )
    last = vc.ROUNDS
    return (
        "WITH "
        + ",\n".join(steps)
        + f""",
coded AS (
  SELECT vector, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM near{last} GROUP BY vector)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{last}) AS codebooks_sha256
FROM coded JOIN read USING (vector)
"""
    )


def all_queries() -> dict[str, str]:
    return {"op12_vector_codes": vector_codes(), "op13_fill_in_middle": FILL_IN_MIDDLE}
