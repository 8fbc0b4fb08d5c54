"""Curated tables computed a second way, in SQL, for the recomputation checks."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Width in cents of the ranges in which ranked amounts are looked for.
PART_CENTS = 100_000


def balance(inflows: DataFrame, outflows: DataFrame) -> DataFrame:
    """``entity, period, total_in, total_out, balance, n_in, n_out, running_balance``.

    Both inputs have ``entity, period, amount`` and only active rows.
    """
    return inflows.sparkSession.sql(
        """
        WITH i AS (SELECT entity, period, sum(amount) AS total, count(*) AS n
                   FROM {inflows} GROUP BY entity, period),
             o AS (SELECT entity, period, sum(amount) AS total, count(*) AS n
                   FROM {outflows} GROUP BY entity, period),
             b AS (SELECT coalesce(i.entity, o.entity) AS entity,
                          coalesce(i.period, o.period) AS period,
                          CAST(coalesce(i.total, 0) AS DECIMAL(18,2)) AS total_in,
                          CAST(coalesce(o.total, 0) AS DECIMAL(18,2)) AS total_out,
                          coalesce(i.n, 0) AS n_in, coalesce(o.n, 0) AS n_out
                   FROM i FULL JOIN o ON i.entity <=> o.entity AND i.period <=> o.period)
        SELECT entity, period, total_in, total_out,
               CAST(total_in - total_out AS DECIMAL(18,2)) AS balance, n_in, n_out,
               CAST(sum(total_in - total_out) OVER (PARTITION BY entity ORDER BY period
                    ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS running_balance
        FROM b
        """,
        inflows=inflows,
        outflows=outflows,
    )


def spend(outflows: DataFrame, catalogue: DataFrame, sentinel, missing: str) -> DataFrame:
    """``entity, period, dim_id, label, total, n, prior_total, change_pct``.

    ``outflows`` has ``entity, period, dim_id, amount``; ``catalogue`` has ``id, name``.
    """
    return outflows.sparkSession.sql(
        """
        WITH m AS (SELECT entity, period, coalesce(dim_id, :sentinel) AS dim_id,
                          CAST(coalesce(sum(amount), 0) AS DECIMAL(18,2)) AS total, count(*) AS n
                   FROM {outflows} GROUP BY entity, period, coalesce(dim_id, :sentinel)),
             p AS (SELECT entity, dim_id, add_months(period, 1) AS period, total AS prior_total FROM m)
        SELECT m.entity, m.period, m.dim_id, coalesce(c.name, :missing) AS label, m.total, m.n,
               p.prior_total,
               CAST(CASE WHEN p.prior_total <> 0
                    THEN round((m.total - p.prior_total) * 100 / p.prior_total, 2) END
                    AS DECIMAL(26,2)) AS change_pct
        FROM m
        LEFT JOIN p ON m.entity = p.entity AND m.dim_id = p.dim_id AND m.period = p.period
        LEFT JOIN {catalogue} c ON c.id = m.dim_id
        """,
        args={"sentinel": sentinel, "missing": missing},
        outflows=outflows,
        catalogue=catalogue,
    )


def outliers(rows: DataFrame, min_rows: int, mild: str, extreme: str, mild_name: str, extreme_name: str) -> DataFrame:
    """``id, n_group, q1, q3, iqr, mild_fence, extreme_fence, excess, severity`` of high amounts.

    ``rows`` has ``id, entity, dim_id, amount``. The amount at a rank is the least one that more rows reach than the rank;
    it is looked for in the ranges of ``:width`` cents around the ranks only.
    """
    return rows.sparkSession.sql(
        """
        WITH c AS (SELECT entity, dim_id, CAST(amount * 100 AS BIGINT) AS cents, count(*) AS n
                   FROM {rows} WHERE entity IS NOT NULL AND dim_id IS NOT NULL GROUP BY ALL),
             r AS (SELECT entity, dim_id, cents DIV :width AS part, sum(n) AS n
                   FROM c GROUP BY entity, dim_id, cents DIV :width),
             p AS (SELECT *, sum(n) OVER (PARTITION BY entity, dim_id) AS n_group,
                          sum(IF(part IS NULL, 0, n)) OVER (PARTITION BY entity, dim_id) - 1 AS last,
                          sum(IF(part IS NULL, 0, n)) OVER (PARTITION BY entity, dim_id ORDER BY part) AS upto FROM r),
             w AS (SELECT * FROM p WHERE part IS NOT NULL AND exists(
                     array(last DIV 4, (last + 3) DIV 4, last * 3 DIV 4, (last * 3 + 3) DIV 4), k -> k < upto AND k >= upto - n)),
             v AS (SELECT w.entity, w.dim_id, n_group, last, cents, upto - w.n + sum(c.n) OVER (
                            PARTITION BY w.entity, w.dim_id, part ORDER BY cents) AS reached
                   FROM w JOIN c ON c.entity = w.entity AND c.dim_id = w.dim_id AND c.cents DIV :width = part),
             e AS (SELECT entity, dim_id, n_group, last, min(cents) FILTER (WHERE reached > last DIV 4) AS a,
                          min(cents) FILTER (WHERE reached > (last + 3) DIV 4) AS b,
                          min(cents) FILTER (WHERE reached > last * 3 DIV 4) AS c,
                          min(cents) FILTER (WHERE reached > (last * 3 + 3) DIV 4) AS d FROM v GROUP BY ALL),
             q AS (SELECT entity, dim_id, n_group,
                          CAST((4 * a + (b - a) * (last % 4)) * 0.0025BD AS DECIMAL(20,4)) AS q1,
                          CAST((4 * c + (d - c) * (last * 3 % 4)) * 0.0025BD AS DECIMAL(20,4)) AS q3 FROM e),
             f AS (SELECT *, q3 - q1 AS iqr, q3 + CAST(:mild AS DECIMAL(6,2)) * (q3 - q1) AS low,
                          q3 + CAST(:extreme AS DECIMAL(6,2)) * (q3 - q1) AS high FROM q)
        SELECT r.id, f.n_group, CAST(round(q1, 2) AS DECIMAL(18,2)) AS q1, CAST(round(q3, 2) AS DECIMAL(18,2)) AS q3,
               CAST(round(iqr, 2) AS DECIMAL(18,2)) AS iqr, CAST(round(low, 2) AS DECIMAL(18,2)) AS mild_fence,
               CAST(round(high, 2) AS DECIMAL(18,2)) AS extreme_fence,
               CAST(round(r.amount - low, 2) AS DECIMAL(18,2)) AS excess,
               CASE WHEN r.amount > high THEN :extreme_name ELSE :mild_name END AS severity
        FROM {rows} r JOIN f ON r.entity = f.entity AND r.dim_id = f.dim_id
        WHERE f.n_group >= :min_rows AND iqr > 0 AND r.amount > low
        """,
        args={
            "mild": mild, "extreme": extreme, "min_rows": min_rows, "width": PART_CENTS,
            "mild_name": mild_name, "extreme_name": extreme_name,
        },
        rows=rows,
    )
