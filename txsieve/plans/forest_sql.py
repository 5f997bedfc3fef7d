"""DuckDB SQL that draws the samples, grows the trees and scores the rows of a forest anew."""

from __future__ import annotations

from txsieve.operators.iforest import EULER_GAMMA, OVERSAMPLE, ROUNDING, average_path
from txsieve.schemas import CAP_QUANTILE, CONTAMINATION, FEATURES, MAX_SAMPLES, N_TREES, SEED

DEPTH = 8
_PRESENT = " and ".join(f"{name} is not null" for name in FEATURES)


def _uniform(digest: str, place: int = 0) -> str:
    return f"(('0x' || substr({digest}, {13 * place + 1}, 13))::bigint / 4503599627370496.0)"


def _scaled(source: str, alias: str) -> str:
    """``alias (hash, v)``: capped and standardised features of the rows of ``source``, NULL where one is missing."""
    values = ", ".join(f"(least({n}::double, {n}_cap) - {n}_mean) / {n}_sd" for n in FEATURES)
    return f"{alias} as materialized (select hash, case when {_PRESENT} then [{values}] end as v from ({source}), fitted)"


def grown(source: str) -> str:
    """CTEs up to ``nodes``: the forest that is fitted to the complete rows of ``source``, by their hash."""
    caps = ", ".join(f"quantile_cont({n}::double, {CAP_QUANTILE}) as {n}_cap" for n in FEATURES)
    moments = ", ".join(
        f"any_value({n}_cap) as {n}_cap, printf('%.12g', avg(least({n}::double, {n}_cap)))::double as {n}_mean, "
        f"coalesce(nullif(printf('%.12g', stddev_pop(least({n}::double, {n}_cap)))::double, 0), 1) as {n}_sd"
        for n in FEATURES
    )
    parts = [
        f"present as materialized (select * from ({source}) where {_PRESENT})",
        f"caps as materialized (select {caps} from present)",
        f"fitted as materialized (select {moments} from present, caps)",
        _scaled("select * from present", "scaled"),
        f"""share as materialized (
          select least(1.0::double, {OVERSAMPLE} * least({MAX_SAMPLES}, count(*)) / count(*)) as p,
                 least({MAX_SAMPLES}, count(*)) as psi from present)""",
        f"""law(k, mass, below) as (
          select 0, pow(1 - p, {N_TREES}), pow(1 - p, {N_TREES}) from share where p < 1
          union all
          select k + 1, m, below + m
          from (select k, below, mass * (({N_TREES} - k) / (k + 1) * p / (1 - p)) as m from law, share where k < {N_TREES - 1}))""",
        f"""offered as materialized (
          select hash, v, psi, case when p >= 1 then {N_TREES} else
                 len(list_filter(bounds, lambda b: {_uniform(f"md5('offer:{SEED}:' || hash)")} >= b)) end as offers
          from scaled, share, (select coalesce(list(below), []) as bounds from law))""",
        f"""drawn as (
          select hash, v, psi, unnest(list_reduce(
            list_transform(range({N_TREES} - offers, {N_TREES}), lambda j: {{
              'j': j, 't': floor({_uniform(f"md5('tree:{SEED}:' || hash || ':' || j)")} * (j + 1))::bigint}}),
            lambda taken, s: taken || [case when list_contains(taken, s.t) then s.j else s.t end], []::bigint[])) as tree
          from offered where offers > 0)""",
        f"""level0 as materialized (
          select tree, 0::bigint as node, v from drawn
          qualify row_number() over (partition by tree order by md5('draw:{SEED}:' || tree || ':' || hash)) <= psi)""",
    ]
    low, high = (", ".join(f"{f}(v[{i + 1}])" for i in range(len(FEATURES))) for f in ("min", "max"))
    for k in range(DEPTH + 1):
        usable = "[]::bigint[]" if k == DEPTH else f"list_filter(range({len(FEATURES)}), lambda i: high[i + 1] > low[i + 1])"
        parts.append(f"""
        box{k} as (select tree, node, count(*) as n, [{low}] as low, [{high}] as high from level{k} group by tree, node),
        choice{k} as (
          select *, usable[floor({_uniform("digest")} * len(usable))::int + 1] as feature
          from (select *, {usable} as usable, md5('split:{SEED}:' || tree || ':' || node) as digest from box{k})),
        split{k} as materialized (
          select tree, node, n, feature, case when cut >= high[feature + 1] then low[feature + 1] else cut end as threshold
          from (select *, low[feature + 1] + {_uniform("digest", 1)} * (high[feature + 1] - low[feature + 1]) as cut
                from choice{k}))""")
        if k < DEPTH:
            parts.append(f"""
        level{k + 1} as materialized (
          select tree, 2 * node + 1 + (v[feature + 1] > threshold)::int as node, v
          from level{k} join split{k} using (tree, node) where feature is not null)""")
    union = " union all ".join(f"select *, {k} as depth from split{k}" for k in range(DEPTH + 1))
    parts.append(f"nodes as materialized ({union})")
    return "with recursive " + ",\n".join(parts)


def raw_scores(points: str, name: str) -> str:
    """CTEs up to ``name (hash, raw)``: scores of ``points (hash, v)``, which walk down all trees."""
    parts = [f"{name}0 as (select hash, v, tree, 0::bigint as node from {points}, range({N_TREES}) t(tree) where v is not null)"]
    for k in range(DEPTH):
        parts.append(f"""
        {name}{k + 1} as (
          select hash, v, tree, case when feature is null then node
                 else 2 * node + 1 + (v[feature + 1] > threshold)::int end as node
          from {name}{k} join nodes using (tree, node))""")
    path = f"case when n <= 1 then 0 when n = 2 then 1 else 2 * (ln(n - 1) + {EULER_GAMMA}::double) - 2.0::double * (n - 1) / n end"
    parts.append(f"""
        {name} as materialized (
          select hash, pow(2, -sum(depth + {path}) / ({N_TREES} * {average_path(MAX_SAMPLES)!r}::double)) as raw
          from {name}{DEPTH} join nodes using (tree, node) group by hash)""")
    return ",\n".join(parts)


def nodes_sql(source: str) -> str:
    return f"""{grown(source)}
    select tree::int as tree_id, node::int as node_id, feature::int as feature, round(threshold, 6) as threshold,
           case when feature is not null then (2 * node + 1)::int end as left_id,
           case when feature is not null then (2 * node + 2)::int end as right_id, n::int as n, depth::int as depth
    from nodes"""


def trained(source: str) -> str:
    """CTEs up to ``flagged``: the complete rows of ``source`` with score and flag."""
    return f"""{grown(source)}, {raw_scores("scaled", "fit")},
    bound as materialized (select quantile_cont(raw, {1 - CONTAMINATION}::double) as bound from fit),
    flagged as materialized (
      select present.*, raw - bound as anomaly_score, raw - bound > {ROUNDING}::double as is_anomaly
      from present join fit using (hash), bound)"""


def scores_sql(source: str) -> str:
    """All rows of ``source``; incomplete ones have no score."""
    return f"""{trained(source)}
    select hash, round(anomaly_score, 6) as anomaly_score, is_anomaly
    from (select hash from ({source})) left join flagged using (hash)"""


def verdicts(source: str, requests: str) -> str:
    """CTEs up to ``verdict``: the rows of ``requests`` scored by the forest of ``source``."""
    return f"""{trained(source)}, request as materialized ({requests}),
    {_scaled("select * from request", "asked")}, {raw_scores("asked", "answer")},
    verdict as (
      select request.*, raw - bound as anomaly_score, raw - bound > {ROUNDING}::double as is_anomaly
      from request left join answer using (hash), bound)"""
