"""DuckDB text that draws, grows and walks the isolation forests from the same md5 counters."""

from __future__ import annotations

from terracheck.operators import forest as FO

#: Levels below the root of a tree on at most 256 rows.
_LEVELS = 8


def _bits(seed: int, *parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(parts)})), 1, 8))::BIGINT"


def _text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


def forest_sql(prefix: str, source: str, key: str | None, features: list[str], n_trees: int, seed: int, contamination: float = 0.08, min_rows: int = 1) -> str:
    """CTEs, from ``, `` on: ``{prefix}_sizes``, ``_sample``, ``_nodes``, ``_raw (row_id, model_key,
    raw)``, ``_offsets`` and ``_decided (row_id, model_key, raw, decision)`` of the rows of
    ``source`` with their ``features``, null as 0."""
    p, m = prefix, len(features)
    cols = ", ".join(f"f{i}" for i in range(m))
    filled = ", ".join(f"coalesce(CAST({f} AS DOUBLE), 0.0) AS f{i}" for i, f in enumerate(features))
    model = f"CAST({key} AS VARCHAR)" if key else f"'{FO.GLOBAL_KEY}'"
    c = lambda n: (
        f"CASE WHEN {n} > 2 THEN round((2.0 * (ln({n} - 1.0) + {FO.EULER_GAMMA!r}::DOUBLE) - 2.0 * ({n} - 1.0) / {n}) * 1073741824.0) / 1073741824.0 "
        f"WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"
    )
    out = f"""
, {p}_rows AS (SELECT row_id, {model} AS model_key, {filled}, {_bits(seed, "'row'", _text("row_id"))} % {FO.PLACES} AS x FROM {source}),
{p}_sizes AS (SELECT model_key, count(*) AS n_train, CAST(least({FO.MAX_PSI}, count(*)) AS INTEGER) AS psi FROM {p}_rows
  WHERE model_key IS NOT NULL GROUP BY model_key HAVING count(*) >= {min_rows}),
{p}_trees AS (SELECT CAST(t AS INTEGER) AS t, 1 + {_bits(seed, "'factor'", _text("t"))} % {FO.PLACES - 1} AS a,
  {_bits(seed, "'shift'", _text("t"))} % {FO.PLACES} AS b FROM range({n_trees}) r(t)),
{p}_sample AS MATERIALIZED (SELECT model_key, t, psi, row_id, {cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY model_key, t ORDER BY (a * x + b) % {FO.PLACES},
    md5(concat_ws('|', '{seed}', 'tie', {_text("t")}, {_text("row_id")})), row_id) AS place
  FROM {p}_rows JOIN {p}_sizes USING (model_key) CROSS JOIN {p}_trees) WHERE place <= psi)"""
    live = f"SELECT model_key, t, psi, 0 AS node, {cols} FROM {p}_sample"
    stats = ", ".join(f"min(f{i}) AS lo{i}, max(f{i}) AS hi{i}" for i in range(m))
    varying = "[" + ", ".join(f"CASE WHEN hi{i} > lo{i} THEN {i} END" for i in range(m)) + "]"
    pick = lambda column: "CASE feature " + " ".join(f"WHEN {i} THEN {column}{i}" for i in range(m)) + " END"
    draw = lambda purpose: _bits(seed, f"'{purpose}'", "model_key", _text("t"), _text("node")) + " / 4294967296.0::DOUBLE"
    for d in range(_LEVELS + 1):
        out += f""",
{p}_l{d} AS MATERIALIZED ({live}),
{p}_s{d} AS MATERIALIZED (SELECT *, CASE WHEN feature IS NULL THEN NULL ELSE low + {draw("threshold")} * (high - low) END AS threshold FROM (
  SELECT *, {pick("lo")} AS low, {pick("hi")} AS high FROM (
    SELECT *, CASE WHEN {d} < ceil(log2(greatest(psi, 2))) AND n > 1 AND len(vary) > 0
      THEN vary[1 + least(CAST(floor({draw("feature")} * len(vary)) AS INTEGER), len(vary) - 1)] END AS feature FROM (
      SELECT *, list_filter({varying}, lambda v: v IS NOT NULL) AS vary FROM (
        SELECT model_key, t, psi, node, count(*) AS n, {stats} FROM {p}_l{d} GROUP BY model_key, t, psi, node)))))"""
        live = f"""SELECT model_key, t, l.psi, 2 * node + CASE WHEN {pick("l.f")} <= threshold THEN 1 ELSE 2 END AS node, {", ".join(f"l.f{i}" for i in range(m))}
  FROM {p}_l{d} l JOIN {p}_s{d} USING (model_key, t, node) WHERE feature IS NOT NULL"""
    each = " UNION ALL ".join(
        f"SELECT model_key, t, node, feature, threshold, CASE WHEN feature IS NULL THEN {d} + {c('n')} END AS path FROM {p}_s{d}" for d in range(_LEVELS + 1)
    )
    out += f""",
{p}_grown AS MATERIALIZED ({each}),
{p}_nodes AS (SELECT model_key, t AS tree_id, CAST(node AS INTEGER) AS node_id, CAST(CASE WHEN feature IS NULL THEN -1 ELSE 2 * node + 1 END AS INTEGER) AS "left",
  CAST(CASE WHEN feature IS NULL THEN -1 ELSE 2 * node + 2 END AS INTEGER) AS "right", CAST(coalesce(feature, -1) AS INTEGER) AS feature,
  coalesce(threshold, 0.0) AS threshold, coalesce(path, 0.0) AS path_len FROM {p}_grown),
{p}_w0 AS (SELECT row_id, model_key, t, 0 AS node, CAST(NULL AS DOUBLE) AS path, {cols} FROM {p}_rows JOIN {p}_sizes USING (model_key) CROSS JOIN {p}_trees)"""
    for d in range(_LEVELS + 1):
        out += f""",
{p}_w{d + 1} AS (SELECT row_id, model_key, t, CASE WHEN feature IS NULL THEN w.node ELSE 2 * w.node + CASE WHEN {pick("w.f")} <= threshold THEN 1 ELSE 2 END END AS node,
  g.path AS path, {cols} FROM {p}_w{d} w JOIN {p}_grown g USING (model_key, t, node))"""
    out += f""",
{p}_raw AS MATERIALIZED (SELECT row_id, model_key, CASE WHEN any_value(psi) <= 1 THEN -0.5
    ELSE -power(2.0, -(sum(path) / {n_trees}) / any_value({c('psi')})) END AS raw
  FROM {p}_w{_LEVELS + 1} JOIN {p}_sizes USING (model_key) GROUP BY row_id, model_key),
{p}_offsets AS (SELECT model_key, psi, n_train, quantile_cont(raw, {contamination}) AS "offset" FROM {p}_raw JOIN {p}_sizes USING (model_key) GROUP BY model_key, psi, n_train),
{p}_decided AS (SELECT row_id, model_key, raw, raw - "offset" AS decision FROM {p}_raw JOIN {p}_offsets USING (model_key))"""
    return out
