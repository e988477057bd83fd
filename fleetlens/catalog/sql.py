"""Checking SQL: named common table expressions and how to put them together.

Flat windows are written directly as windows over the whole table, without chunks, so they check
the chunked form independently.
"""

from __future__ import annotations

from collections.abc import Sequence

from fleetlens.adapters import FOLDS, START_AFTER
from fleetlens.catalog.registry import TIE_SHIFT
from fleetlens.schemas import (
    COMPONENTS,
    ERROR_CODES,
    ERROR_COUNTS,
    MEAN_BIN,
    MEAN_ROLL,
    MEASURES,
    MODELS,
    SD_BIN,
    SD_ROLL,
)

SENSOR = (*MEAN_BIN, *SD_BIN, *MEAN_ROLL, *SD_ROLL)


def rnd(expression: str, name: str | None = None, digits: int = 4) -> str:
    return f"round({expression} + {TIE_SHIFT}, {digits}) AS {name or expression}"


def cols(names: Sequence[str], template: str = "{c}") -> str:
    return ", ".join(template.format(c=c) for c in names)


def rnds(names: Sequence[str]) -> str:
    return ", ".join(rnd(n) for n in names)


def bucket(ts: str, days: int) -> str:
    return f"time_bucket(INTERVAL {days} DAYS, {ts}, TIMESTAMP '1970-01-01')"


_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, text: str, *needs: str) -> None:
    _CTES[name] = (needs, text)


def compose(body: str, *needs: str) -> str:
    """``WITH`` all needed expressions, in order, and the body."""
    wanted: list[str] = []

    def visit(name: str) -> None:
        if name not in wanted:
            for inner in _CTES[name][0]:
                visit(inner)
            wanted.append(name)

    for name in needs:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in wanted) + "\n" + body


SLOT = bucket("l_shipdate", 10)

cte("telemetry", f"""SELECT {SLOT} AS datetime, l_suppkey AS machineID, l_quantity AS volt,
  l_extendedprice AS rotate, l_discount * 100 AS pressure, l_tax * 100 AS vibration FROM lineitem""")
cte("errors", f"""SELECT {SLOT} AS datetime, l_suppkey AS machineID,
  'error' || CAST(l_partkey % 5 + 1 AS VARCHAR) AS errorID
  FROM lineitem WHERE l_quantity <= 5 AND l_returnflag = 'R'""")
cte("maint", f"""SELECT {SLOT} AS datetime, l_suppkey AS machineID,
  'comp' || CAST(l_partkey % 4 + 1 AS VARCHAR) AS comp FROM lineitem WHERE l_discount >= 0.10""")
cte("failures", f"""SELECT {SLOT} AS datetime, l_suppkey AS machineID,
  'comp' || CAST(l_partkey % 4 + 1 AS VARCHAR) AS failure
  FROM lineitem WHERE l_tax >= 0.08 AND l_quantity >= 40""")
cte("machines", """SELECT s_suppkey AS machineID, 'model' || CAST(s_nationkey % 4 + 1 AS VARCHAR) AS model,
  CAST(s_nationkey % 21 AS BIGINT) AS age FROM supplier""")

cte("slots", f"SELECT machineID, datetime, {cols(MEASURES, 'avg({c}) AS {c}')} FROM telemetry GROUP BY machineID, datetime",
    "telemetry")
cte("error_counts", f"""SELECT machineID, datetime,
  {cols(ERROR_CODES, "count(*) FILTER (WHERE errorID = '{c}') AS {c}")} FROM errors GROUP BY machineID, datetime""", "errors")
cte("error_slots", f"""SELECT s.machineID, s.datetime, {cols(ERROR_CODES, "CAST(coalesce({c}, 0) AS DOUBLE) AS {c}")}
  FROM slots s LEFT JOIN error_counts e ON s.machineID = e.machineID AND s.datetime = e.datetime""", "slots", "error_counts")
_BIN = bucket("datetime", 30) + " + INTERVAL 30 DAYS"
cte("bins", f"""SELECT machineID, {_BIN} AS datetime, {cols(MEASURES, 'avg({c}) AS {c}mean_3h')},
  {cols(MEASURES, 'stddev_samp({c}) AS {c}sd_3h')},
  {cols(MEASURES, 'arg_min({c}, datetime) FILTER (WHERE {c} IS NOT NULL) AS {c}')}
  FROM slots GROUP BY machineID, {_BIN}""", "slots")
cte("error_bins", f"""SELECT machineID, {_BIN} AS datetime, {cols(ERROR_CODES, 'arg_min({c}, datetime) AS {c}')}
  FROM error_slots GROUP BY machineID, {_BIN}""", "error_slots")
cte("grid", """SELECT machineID, datetime FROM (SELECT DISTINCT machineID FROM telemetry)
  CROSS JOIN (SELECT unnest(generate_series((SELECT min(datetime) FROM bins), (SELECT max(datetime) FROM bins),
  INTERVAL 30 DAYS)) AS datetime)""", "telemetry", "bins")
cte("grid_bins", f"""SELECT g.machineID, g.datetime, {cols((*MEAN_BIN, *SD_BIN, *MEASURES, *ERROR_CODES))} FROM grid g
  LEFT JOIN bins b ON g.machineID = b.machineID AND g.datetime = b.datetime
  LEFT JOIN error_bins e ON g.machineID = e.machineID AND g.datetime = e.datetime""", "grid", "bins", "error_bins")
for _mode, _part in (("flat", ""), ("keyed", "PARTITION BY machineID ")):
    _full = "CASE WHEN count({c}) OVER w = 24 THEN {f}({c}) OVER w END AS {c}"
    cte(f"rolled_{_mode}", f"""SELECT machineID, datetime, row_number() OVER (ORDER BY machineID, datetime) AS g,
  {cols((*MEAN_BIN, *SD_BIN))},
  {cols(MEASURES, _full.replace('{f}', 'avg') + 'mean_24h')},
  {cols(MEASURES, _full.replace('{f}', 'stddev_samp') + 'sd_24h')},
  {cols(ERROR_CODES, _full.replace('{f}', 'sum') + 'count')}
  FROM grid_bins WINDOW w AS ({_part}ORDER BY machineID, datetime ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""", "grid_bins")
    cte(f"err_{_mode}", f"""SELECT machineID, datetime, {cols(ERROR_COUNTS)} FROM rolled_{_mode}
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ERROR_COUNTS)}""", f"rolled_{_mode}")
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in SENSOR)
cte("moved_sd", f"""SELECT row_number() OVER (ORDER BY g) AS g, {cols(SD_ROLL)} FROM rolled_flat
  WHERE voltsd_24h IS NOT NULL""", "rolled_flat")
cte("tele_flat", f"""SELECT machineID, datetime, {cols(SENSOR)} FROM
  (SELECT r.g, machineID, datetime, {cols((*MEAN_BIN, *SD_BIN, *MEAN_ROLL))}, {cols(SD_ROLL, 'm.{c}')}
   FROM rolled_flat r JOIN moved_sd m ON r.g = m.g) WHERE {_COMPLETE}""", "rolled_flat", "moved_sd")
cte("tele_keyed", f"SELECT machineID, datetime, {cols(SENSOR)} FROM rolled_keyed WHERE {_COMPLETE}", "rolled_keyed")

cte("comp_counts", f"""SELECT machineID, datetime, {cols(COMPONENTS, "count(*) FILTER (WHERE comp = '{c}') AS {c}")}
  FROM maint GROUP BY machineID, datetime""", "maint")
for _mode, _spine, _part in (
    ("flat", "SELECT machineID, datetime FROM telemetry", ""),
    ("keyed", "SELECT DISTINCT machineID, datetime FROM telemetry", "PARTITION BY machineID "),
):
    cte(f"filled_{_mode}", f"""SELECT coalesce(s.machineID, k.machineID) AS machineID, coalesce(s.datetime, k.datetime) AS datetime,
  {cols(COMPONENTS, 'CASE WHEN coalesce({c}, 0) >= 1 THEN coalesce(s.datetime, k.datetime) END AS {c}')}
  FROM ({_spine}) s FULL JOIN comp_counts k ON s.machineID = k.machineID AND s.datetime = k.datetime""", "telemetry", "comp_counts")
    cte(f"replaced_{_mode}", f"""SELECT machineID, datetime, {cols(COMPONENTS, 'last_value({c} IGNORE NULLS) OVER w AS {c}')}
  FROM filled_{_mode} WINDOW w AS ({_part}ORDER BY machineID, datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        f"filled_{_mode}")
    cte(f"maint_{_mode}", f"""SELECT datetime, machineID,
  {cols(COMPONENTS, '(epoch_us(datetime) - epoch_us({c})) / 86400000000.0 AS {c}')}
  FROM replaced_{_mode} WHERE datetime > TIMESTAMP '{START_AFTER}'""", f"replaced_{_mode}")
    cte(f"final_{_mode}", f"""SELECT t.*, {cols(ERROR_COUNTS)}, {cols(COMPONENTS)}, model, age FROM tele_{_mode} t
  LEFT JOIN err_{_mode} e ON t.machineID = e.machineID AND t.datetime = e.datetime
  LEFT JOIN maint_{_mode} k ON t.machineID = k.machineID AND t.datetime = k.datetime
  LEFT JOIN machines m ON t.machineID = m.machineID""", f"tele_{_mode}", f"err_{_mode}", f"maint_{_mode}", "machines")
    cte(f"joined_{_mode}", f"""SELECT f.*, x.failure AS raw_failure FROM final_{_mode} f
  LEFT JOIN failures x ON f.machineID = x.machineID AND f.datetime = x.datetime""", f"final_{_mode}", "failures")
    cte(f"labeled_{_mode}", f"SELECT * EXCLUDE (raw_failure), coalesce(raw_failure, 'none') AS failure FROM joined_{_mode}",
        f"joined_{_mode}")
    cte(f"backfilled_{_mode}", f"""SELECT * EXCLUDE (raw_failure), coalesce(first_value(raw_failure IGNORE NULLS) OVER
  ({_part}ORDER BY machineID, datetime, raw_failure NULLS LAST ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING), 'none') AS failure
  FROM joined_{_mode}""", f"joined_{_mode}")
    _dummies = ", ".join(f"CASE WHEN model = '{m}' THEN 1 ELSE 0 END AS model_{m}" for m in MODELS)
    cte(f"matrix_{_mode}", f"""SELECT machineID, datetime, {cols((*SENSOR, *ERROR_COUNTS, *COMPONENTS))}, age, {_dummies}, failure
  FROM labeled_{_mode}""", f"labeled_{_mode}")

FEATURES_OUT = f"machineID, datetime, {rnds((*SENSOR, *ERROR_COUNTS, *COMPONENTS))}, model, age"
MATRIX_DOUBLES = (*SENSOR, *ERROR_COUNTS, *COMPONENTS)
LAST_FOLD = FOLDS[-1]
