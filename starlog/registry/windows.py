"""Window reports over the employees frame and the log's phases."""

from __future__ import annotations

from pyspark.sql import functions as F

from starlog.operators import windows as win
from starlog.plans import events as event_jobs
from starlog.registry import query
from starlog.registry import standins as std


@query(f"""WITH {std.EMPLOYEES}, placed AS (SELECT *, row_number() OVER (PARTITION BY dept ORDER BY salary, id) AS n FROM emp)
SELECT dept, piece, list, CAST(t.total AS BIGINT) AS total, CAST(t.total AS DOUBLE) / t.rows AS average, t.rows FROM
  (SELECT dept, (n - 1) // 1000 AS piece, string_agg(CAST(salary AS VARCHAR), ',' ORDER BY n) AS list FROM placed GROUP BY ALL)
  JOIN (SELECT dept, SUM(salary) AS total, COUNT(*) AS rows FROM emp GROUP BY dept) t USING (dept)""")
def group_list_avg_sum(spark, d):
    """Salary list (in pieces of at most 1000), average and total per department."""
    lists = win.group_lists(std.employees(spark, d), ["dept"], ["salary", "id"], "salary", piece_rows=1000)
    return lists.withColumn("list", F.concat_ws(",", F.col("list").cast("array<string>")))


@query(f"""WITH {std.EMPLOYEES} SELECT id, dept, salary, CAST(SUM(salary) OVER w AS BIGINT) AS total,
  CAST(SUM(salary) OVER w AS DOUBLE) / COUNT(*) OVER w AS average, COUNT(*) OVER w AS rows
FROM emp WINDOW w AS (PARTITION BY dept)""")
def win_partition_agg(spark, d):
    return win.group_totals(std.employees(spark, d), ["dept"], "salary")


@query(f"""WITH {std.EMPLOYEES} SELECT id, dept, salary, CAST(SUM(salary) OVER w AS BIGINT) AS total,
  CAST(SUM(salary) OVER w AS DOUBLE) / COUNT(*) OVER w AS average, COUNT(*) OVER w AS rows
FROM emp WINDOW w AS (PARTITION BY dept ORDER BY salary)""")
def win_running_range(spark, d):
    return win.running_range_stats(std.employees(spark, d), ["dept"], "salary", "salary")


@query(f"""WITH {std.EMPLOYEES} SELECT id, dept, salary, CAST(SUM(salary) OVER w AS BIGINT) AS total,
  CAST(SUM(salary) OVER w AS DOUBLE) / COUNT(*) OVER w AS average, COUNT(*) OVER w AS rows
FROM emp WINDOW w AS (PARTITION BY dept ORDER BY salary, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def win_running_rows(spark, d):
    return win.running_rows(std.employees(spark, d), ["dept"], ["salary", "id"], "salary")


@query(f"""WITH {std.EMPLOYEES} SELECT id, dept, salary, CAST(SUM(salary) OVER w AS BIGINT) AS total,
  CAST(SUM(salary) OVER w AS DOUBLE) / COUNT(*) OVER w AS average,
  array_to_string(list(salary) OVER w, ',') AS list
FROM emp WINDOW w AS (PARTITION BY dept ORDER BY salary, id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)""")
def win_moving_rows(spark, d):
    moved = win.moving_pair(std.employees(spark, d), ["dept"], ["salary", "id"], "salary")
    return moved.withColumn("list", F.concat_ws(",", F.col("list").cast("array<string>")))


@query(f"""WITH {std.EMPLOYEES} SELECT dept, string_agg(CAST(salary AS VARCHAR), ',' ORDER BY n) AS list,
  MAX(CASE WHEN n = 3 THEN salary END) AS third FROM
  (SELECT *, row_number() OVER (PARTITION BY dept ORDER BY salary, id) AS n, COUNT(*) OVER (PARTITION BY dept) AS c FROM emp)
WHERE n <= 4 AND c >= 4 GROUP BY dept""")
def win_frame_list(spark, d):
    """The running salary list as it stands at the fourth row of each department, and its third element."""
    lists = win.frame_list_at(std.employees(spark, d), ["dept"], ["salary", "id"], "salary", 4)
    lists = lists.withColumn("third", F.element_at("list", 3))
    return lists.withColumn("list", F.concat_ws(",", F.col("list").cast("array<string>")))


_RUNNING_LISTS = f"""WITH {std.EMPLOYEES}, placed AS (SELECT *, row_number() OVER (PARTITION BY dept ORDER BY salary, id) AS n FROM emp)
SELECT c.id, c.dept, c.salary, (e.n - 1) // 1000 AS piece, string_agg(CAST(e.id AS VARCHAR), ',' ORDER BY e.n) AS list
FROM placed c JOIN placed e ON c.dept = e.dept AND {{frame}} WHERE c.id % 50 = 0 GROUP BY ALL"""


def _running_lists(spark, d, frame):
    rows, pieces = win.factorised_lists(std.employees(spark, d), ["dept"], ["salary", "id"], "id", frame)
    texts = pieces.withColumn("list", F.col("list").cast("array<string>"))
    lists = win.expand_lists(rows.where("id % 50 = 0"), texts, ["dept"])
    return lists.withColumn("list", F.concat_ws(",", "list")).drop("prefix")


@query(_RUNNING_LISTS.format(frame="e.n <= c.n"))
def win_running_lists(spark, d):
    """The list of all employees up to a row, for the rows whose id is divisible by 50."""
    return _running_lists(spark, d, "rows")


@query(_RUNNING_LISTS.format(frame="e.salary <= c.salary"))
def win_running_lists_range(spark, d):
    """The same where rows of one salary share a list."""
    return _running_lists(spark, d, "range")


@query(f"""WITH {std.EMPLOYEES} SELECT id, dept, salary, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank,
  percent_rank() OVER w AS percent_rank FROM emp WINDOW w AS (PARTITION BY dept ORDER BY salary)""")
def win_ranking(spark, d):
    return win.ranks(std.employees(spark, d), ["dept"], "salary")


@query(f"""WITH {std.EMPLOYEES} SELECT id, dept, salary, lag(salary) OVER w AS lag, salary - lag(salary) OVER w AS diff
FROM emp WINDOW w AS (PARTITION BY dept ORDER BY salary, id)""")
def win_lag_diff(spark, d):
    return win.difference_to_previous(std.employees(spark, d), ["dept"], ["salary", "id"], "salary")


@query(f"""WITH {std.LOG} SELECT event_id, userId, ts, CASE WHEN page = 'error' THEN 1 ELSE 0 END AS downgrade,
  CAST(SUM(CASE WHEN page = 'error' THEN 1 ELSE 0 END) OVER
    (PARTITION BY userId ORDER BY ts DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS phase
FROM log WHERE userId <> '' AND sessionId IS NOT NULL""")
def phase_from_downgrade(spark, d):
    return event_jobs.downgrade_phases(std.log(spark, d), std.DOWNGRADE).select("event_id", "userId", "ts", "downgrade", "phase")
