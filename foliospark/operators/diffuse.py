"""Labels spread along lines: unlabelled rows take over from labelled ones at most 20 rows to the left
or 19 to the right on the same line. Membership, order and block have a closed form in windows; the
voted label depends on earlier votes and has an exact fold for each document besides."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame

#: Rows looked at to the left and to the right.
LEFT, RIGHT = 20, 19

#: One text for Spark and other SQL engines; {t}: doc_id, line_no, pos, label, raw, block.
SPREAD = f"""
WITH a AS (SELECT *, CASE WHEN label IS NOT NULL THEN 1 ELSE 0 END AS o,
  CASE WHEN pos - lag(pos) OVER (PARTITION BY doc_id, line_no ORDER BY pos) > {LEFT} THEN 1 ELSE 0 END AS cut FROM {{t}}),
b AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id, line_no ORDER BY pos ROWS UNBOUNDED PRECEDING) AS isl,
  greatest(o, coalesce(max(o) OVER (PARTITION BY doc_id, line_no ORDER BY pos RANGE BETWEEN 1 FOLLOWING AND {RIGHT} FOLLOWING), 0)) AS seed FROM a),
c AS (SELECT *, max(seed) OVER (PARTITION BY doc_id, line_no, isl ORDER BY pos ROWS UNBOUNDED PRECEDING) AS act FROM b),
d AS (SELECT *, act * (1 - o) AS dif FROM c),
e AS (SELECT *, coalesce(sum(dif) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off,
  sum(dif) OVER (PARTITION BY doc_id, line_no, isl ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cd FROM d),
f AS (SELECT *, last_value(CASE WHEN o = 1 THEN raw + off END IGNORE NULLS) OVER up AS left_ro, last_value(CASE WHEN o = 1 THEN cd END IGNORE NULLS) OVER up AS left_cd,
  last_value(CASE WHEN o = 1 THEN block END IGNORE NULLS) OVER up AS left_block, first_value(CASE WHEN o = 1 THEN raw END IGNORE NULLS) OVER down AS right_raw,
  first_value(CASE WHEN o = 1 THEN block END IGNORE NULLS) OVER down AS right_block, min(CASE WHEN act = 1 THEN off END) OVER (PARTITION BY doc_id, line_no, isl) AS first_off FROM e
  WINDOW up AS (PARTITION BY doc_id, line_no, isl ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  down AS (PARTITION BY doc_id, line_no, isl ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT doc_id, line_no, pos, text, label, CAST(dif AS INT) AS diffused, CAST(off AS INT) AS spread_before,
  CAST(CASE WHEN o = 1 THEN raw + off WHEN dif = 1 AND left_ro IS NOT NULL THEN left_ro + cd - left_cd WHEN dif = 1 THEN right_raw + first_off + cd - 1 ELSE -1 END AS INT) AS reading_order,
  CAST(CASE WHEN act = 1 THEN coalesce(left_block, right_block) ELSE -1 END AS INT) AS block_id FROM f
"""


def spread(rows: DataFrame) -> DataFrame:
    """doc_id, line_no, pos, text, label, diffused, spread_before, reading_order, block_id."""
    return rows.sparkSession.sql(SPREAD.replace(" IGNORE NULLS) OVER", ") IGNORE NULLS OVER"), t=rows)


VOTES = f"""
WITH v AS (SELECT doc_id, line_no, pos, label, collect_list(label) OVER (PARTITION BY doc_id, line_no ORDER BY pos RANGE BETWEEN {LEFT} PRECEDING AND {RIGHT} FOLLOWING) AS a FROM {{t}})
SELECT doc_id, line_no, pos, coalesce(label, array_max(transform(array_distinct(a), x -> named_struct('n', size(filter(a, y -> y = x)), 'p', -array_position(a, x), 'x', x))).x) AS label FROM v
"""


def vote_originals(rows: DataFrame) -> DataFrame:
    """The most frequent original label around an unlabelled row, the farthest left one at a tie."""
    return rows.sparkSession.sql(VOTES, t=rows)


def fold(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("pos", kind="stable").reset_index(drop=True)
    n = len(group)
    line, label = group["line_no"].tolist(), [None if pd.isna(x) else x for x in group["label"]]
    raw = [-1 if pd.isna(x) else int(x) for x in group["raw"]]
    original = [x is not None for x in label]
    order, block, offset = [-1] * n, [-1] * n, 0
    own = [-1 if pd.isna(x) else int(x) for x in group["block"]]
    for i in range(n):
        if original[i]:
            order[i], block[i] = raw[i] + offset, own[i]
            continue
        left = [j for j in range(max(0, i - LEFT), i) if line[j] == line[i] and label[j] is not None]
        right = [j for j in range(i + 1, min(n, i + 1 + RIGHT)) if line[j] == line[i] and original[j]]
        if not left and not right:
            continue
        if left:
            near = left[-1]
            order[i], block[i] = order[near] + 1, block[near]
            if right:
                seen: dict[str, int] = {}
                for j in left + right:
                    seen[label[j]] = seen.get(label[j], 0) + 1
                label[i] = max(seen, key=seen.get)
            else:
                label[i] = label[near]
        else:
            near = right[0]
            order[i], block[i], label[i] = raw[near] + offset, own[near], label[near]
        offset += 1
    return pd.DataFrame({"doc_id": group["doc_id"], "line_no": group["line_no"], "pos": group["pos"], "label": label, "reading_order": order, "block_id": block})


def spread_exact(rows: DataFrame) -> DataFrame:
    """The sequential rule itself, a document at a time."""
    return rows.select("doc_id", "line_no", "pos", "label", "raw", "block").groupBy("doc_id").applyInPandas(fold, "doc_id long, line_no int, pos int, label string, reading_order int, block_id int")
