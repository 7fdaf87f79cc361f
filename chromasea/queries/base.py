"""Registry, rounding and the fixture views shared by the queries and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Elements of a vector of the table `embeddings`.
VECTOR = 64

TABLES = ("lineitem", "orders", "events", "part", "embeddings", "supplier", "customer", "nation")

# Divisors are no round numbers, so that means of few decimals don't lie on rounding ties.
# Views over the driver tables, in an SQL that both engines accept but for the
# macros FMT (compact timestamp), DIV (integer division) and ELT (array element,
# from 1). A view may refer to tables in braces and to other views by name.
VIEWS: dict[str, str] = {
    "obs": """
        select cast(l_suppkey as bigint) as granule_id,
          case when l_suppkey % 2 = 0 then 'S3A' else 'S3B' end as platform,
          cast(l_shipdate as date) as obs_date,
          cast(l_partkey % 20 as int) as y, cast(l_orderkey % 20 as int) as x,
          cast(2 + (case when l_quantity >= 46 then 8 else 0 end)
            + (case when l_returnflag = 'R' and l_linenumber = 7 then 4 else 0 end)
            + (case when l_discount > 0.095e0 then 65536 else 0 end) as bigint) as flags,
          case when l_tax > 0.075e0 and l_linenumber = 1 then null
               else l_extendedprice / 1.00037e7 - 0.0004e0 end as rrs443,
          (l_extendedprice + 1000e0 * l_quantity) / 1.50037e7 as rrs490,
          (0.6e0 * l_extendedprice + 1500e0 * l_quantity) / 1.60037e7 as rrs510,
          (0.3e0 * l_extendedprice + 2000e0 * l_quantity) / 2.00037e7 as rrs560,
          (0.02e0 * l_extendedprice + 100e0 * l_quantity) / 2.00037e7 - 0.00005e0 as rrs665,
          l_quantity * 1.1e0 as oza
        from {lineitem}""",
    # obs with its default mask and the three-state weight mask
    "scene": """
        select *,
          case when (flags & 65548) <> 0 or rrs443 is null then 1 else 0 end as mask_default,
          case when granule_id % 10 = 0 and y = 0 then null
               when (flags & 65548) <> 0 or rrs443 is null then 0 else 1 end as mask
        from obs""",
    "daily": """
        select cast(l_shipdate as date) as obs_date,
          cast(l_partkey % 20 as int) as y, cast(l_orderkey % 20 as int) as x,
          avg(case when l_quantity > 3 then l_extendedprice / 1.99937e4 else null end) as chl
        from {lineitem} group by 1, 2, 3""",
    "granules": """
        select event_id as granule_id,
          case when event_id % 2 = 0 then 'S3A' else 'S3B' end as platform,
          ts as start_ts, cast(ts as date) as obs_date, cast(user_id % 385 as int) as rel_orbit,
          case when event_type = 'purchase' then 'NR' else 'NT' end as timeliness,
          cast((event_id * 37) % 900 as int) as y_min,
          cast((event_id * 37) % 900 + 40 + event_id % 60 as int) as y_max,
          cast((event_id * 53) % 900 as int) as x_min,
          cast((event_id * 53) % 900 + 40 + event_id % 70 as int) as x_max,
          cast(floor(value * 10) as bigint) as n_valid,
          concat(case when event_id % 2 = 0 then 'S3A' else 'S3B' end, '_OL_2_WFR____',
            FMT(ts), '_', FMT(ts + interval '3' minute), '_', FMT(ts + interval '1' day),
            '_0180_087_', lpad(cast(user_id % 385 as varchar(3)), 3, '0'), '______MAR_O_',
            case when event_type = 'purchase' then 'NR' else 'NT' end,
            case when event_id % 3 = 0 then '_004.SEN3' else '_003.SEN3' end) as name
        from {events}""",
    # a slanted footprint per granule and a site to test against it
    "footprints": """
        select granule_id, obs_date,
          -170.05e0 + x_min * 0.3e0 as lon0, -170.05e0 + x_max * 0.3e0 as lon1,
          60.013e0 + y_min * 0.025e0 as lat0, 60.013e0 + y_max * 0.025e0 as lat1, 3.7e0 as slant,
          -170e0 + (x_min + n_valid % 97) * 0.3e0 as site_lon,
          60e0 + (y_min + n_valid % 83) * 0.025e0 as site_lat
        from granules""",
    "swath_pts": """
        select o_orderkey as pt, o_orderkey DIV 512 as row, o_orderkey % 512 as col,
          cast(o_custkey % 8 as bigint) as granule_id,
          65e0 + ((o_orderkey * 7919) % 25000) / 1000e0 as lat,
          -180e0 + ((o_orderkey * 104729) % 360000) / 1000e0 as lon,
          o_totalprice as v, case when o_orderstatus = 'F' then 1 else 0 end as mask_default
        from {orders}""",
    # one 5 x 6 tie grid per block of thirty parts, and the pixels that ask for it
    "tie": """
        select p_partkey DIV 30 as granule_id, cast((p_partkey % 30) DIV 6 as int) as j,
          cast(p_partkey % 6 as int) as i, p_retailprice / 20.0137e0 as oza
        from {part}""",
    "tie_pixels": """
        select l_partkey DIV 30 as granule_id, cast((l_orderkey * 7) % 32 as int) as row,
          cast((l_orderkey * 5 + l_linenumber) % 44 as int) as col, l_orderkey as pixel, l_linenumber as line
        from {lineitem}""",
    # a regression model from averaged spectra, and the spectra it is applied to
    "gpr_active": """
        select label, """ + ", ".join(f"avg(ELT(embedding, {i})) as f{i}" for i in range(1, VECTOR + 1)) + """,
          (label - 4.5e0) * 0.01e0 as alpha
        from {embeddings} group by label""",
    "gpr_query": """
        select vec_id, """ + ", ".join(f"cast(ELT(embedding, {i}) as double) as f{i}" for i in range(1, VECTOR + 1)) + """
        from {embeddings}""",
    # five positive bands in realistic proportions for the inversion
    "spectra5": """
        select l_orderkey, l_linenumber,
          0.001e0 + l_extendedprice / 2.5e7 as r412, 0.0012e0 + l_extendedprice / 2.3e7 as r443,
          0.0015e0 + (l_extendedprice + 300e0 * l_quantity) / 2.1e7 as r490,
          0.001e0 + (0.4e0 * l_extendedprice + 800e0 * l_quantity) / 2e7 as r560,
          (0.05e0 * l_extendedprice + 500e0 * l_quantity) / 2e7 - 0.0001e0 as r665
        from {lineitem}""",
}


def _names_in(text: str) -> list[str]:
    return [v for v in VIEWS if re.search(rf"\b(from|join)\s+{v}\b", text)]


def _expand(text: str, fmt: str, div: str, elt: str) -> str:
    text = re.sub(r"FMT\(([^()]*)\)", lambda m: fmt.format(m.group(1)), text)
    text = re.sub(r"ELT\((\w+), (\d+)\)", lambda m: elt.format(m.group(1), m.group(2)), text)
    return text.replace(" DIV ", div)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view as a lazy DataFrame over the Parquet tables."""
    text = _expand(VIEWS[name], "date_format({0}, \"yyyyMMdd'T'HHmmss\")", " div ", "element_at({0}, {1})")
    args = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in text}
    for v in _names_in(text):
        text = re.sub(rf"\b(from|join)\s+{v}\b", rf"\1 {{{v}}}", text)
        args[v] = view(spark, sf_dir, v)
    return spark.sql(text, **args)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_views(body: str, *extra: tuple[str, str]) -> str:
    """The same views as common table expressions for DuckDB, in front of `body`."""
    order: list[str] = []

    def visit(text: str) -> None:
        for v in _names_in(text):
            if v not in order:
                visit(VIEWS[v])
                order.append(v)

    visit(body)
    for _, text in extra:
        visit(text)
    ctes = [
        (v, _expand(VIEWS[v], "strftime({0}, '%Y%m%dT%H%M%S')", " // ", "{0}[{1}]").replace("{", "").replace("}", ""))
        for v in order
    ] + list(extra)
    if not ctes:
        return body
    if body.lstrip().startswith("with"):
        body = f"select * from (\n{body}\n) as q"
    return "with " + ",\n".join(f"{n} as ({t})" for n, t in ctes) + "\n" + body


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round the named doubles; adding zero turns a negative zero into zero."""
    return df.withColumns({c: F.round(F.col(c), d) + F.lit(0.0) for c, d in digits.items()})


def query(name: str, sql: str | None = None, digits: int | Mapping[str, int] | None = None,
          doubles: Sequence[str] = (), views: Sequence[tuple[str, str]] = ()):
    """Register a query and its SQL; `doubles` are rounded to `digits` on both sides."""
    spec = {c: digits for c in doubles} if isinstance(digits, int) else dict(digits or {})

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return rounded(df, spec) if spec else df

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            body = sql
            if spec:
                replaced = ", ".join(f"round({c}, {d}) + 0e0 as {c}" for c, d in spec.items())
                body = f"select * replace ({replaced}) from (\n{sql}\n) as q"
            ORACLES[name] = with_views(body, *views)
        return fn

    return register
