"""A broker manifest checked against what the server reports. Findings: campo, manifesto, servidor, severidade, nota."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions.values import is_placeholder
from tickforge.schemas import SPECS_ID

ERRO, PENDENTE, INFO = "erro", "pendente", "info"
#: Manifest field, server field and type of the pairs that must agree.
FIELDS = [
    ("symbol.contract_oz", "specs.trade_contract_size", "number"),
    ("symbol.digits", "specs.digits", "number"),
    ("symbol.volume_min", "specs.volume_min", "number"),
    ("symbol.volume_max", "specs.volume_max", "number"),
    ("symbol.volume_step", "specs.volume_step", "number"),
    ("symbol.stops_level_points", "specs.trade_stops_level", "number"),
    ("execution.account_mode", "account.margin_mode", "text"),
    ("account.currency", "account.currency", "text"),
    ("account.profit_currency", "specs.currency_profit", "text"),
]
SCHEMA = "campo string, manifesto string, servidor string, severidade string, nota string"


def flatten(document: dict, prefix: str = "") -> dict[str, object]:
    """Leaf paths of a nested document; lists are leaves. An absent path is not in the result, a null one is."""
    out: dict[str, object] = {}
    for name, value in document.items():
        path = f"{prefix}.{name}" if prefix else name
        out |= flatten(value, path) if isinstance(value, dict) and value else {path: value}
    return out


def paths(spark: SparkSession, documents: dict[str, dict]) -> DataFrame:
    """(doc, path, value) of small parsed documents, values as text, lists joined by '|'."""
    text = lambda v: None if v is None else "|".join(map(str, v)) if isinstance(v, (list, tuple)) else str(v)
    rows = [(doc, p, text(v)) for doc, d in documents.items() for p, v in flatten(d).items()]
    return spark.createDataFrame(rows, "doc string, path string, value string")


def _pick(docs: DataFrame, side: str) -> DataFrame:
    """doc, and a map of that side's paths; `docs` has doc, side, path, value."""
    return docs.where(F.col("side") == side).groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("path", "value"))).alias(side[0]))


def _finding(field: Column | str, m: Column, s: Column, severity: Column | str, note: Column | str) -> Column:
    as_col = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(as_col(field).alias("campo"), m.alias("manifesto"), s.alias("servidor"), as_col(severity).alias("severidade"), as_col(note).alias("nota"))


def _field(m_path: str, s_path: str, kind: str) -> Column:
    m, s = F.col("m")[m_path], F.col("s")[s_path]
    has_m, has_s = F.map_contains_key("m", F.lit(m_path)), F.map_contains_key("s", F.lit(s_path))
    if kind == "number":
        a, b = F.expr(f"try_cast(m['{m_path}'] as double)"), F.expr(f"try_cast(s['{s_path}'] as double)")
        same = F.abs(a - b) <= F.greatest(F.lit(1e-9) * F.greatest(F.abs(a), F.abs(b)), F.lit(1e-12))
        bad = a.isNull() | b.isNull()
    else:
        same, bad = F.lower(F.trim(m)) == F.lower(F.trim(s)), m.isNull() | s.isNull()
    return (
        F.when(~has_s, _finding(m_path, m, s, ERRO, "the server does not report it"))
        .when(~has_m | m.isNull() | is_placeholder(m), _finding(m_path, m, s, PENDENTE, "not filled in"))
        .when(bad, _finding(m_path, m, s, ERRO, "not comparable"))
        .when(~same, _finding(m_path, m, s, ERRO, "differs"))
    )


def _items(column: str, path: str) -> Column:
    return F.filter(F.split(F.coalesce(F.col(column)[path], F.lit("")), r"\|"), lambda x: x != "")


def verify(docs: DataFrame) -> DataFrame:
    """docs: doc, side ('manifest' or 'specs'), path, value. Returns doc and its findings, errors first, then by field."""
    both = _pick(docs, "manifest").join(_pick(docs, "specs"), "doc")
    s = lambda p: F.col("s")[p]
    m = lambda p: F.col("m")[p]
    wrong = F.when(~s("schema").eqNullSafe(F.lit(SPECS_ID)), F.raise_error(F.concat(F.lit("unknown specs schema: "), F.coalesce(s("schema"), F.lit("none")))))
    declared, offered = _items("m", "execution.filling"), _items("s", "specs.filling_mode")
    lost, extra = F.array_except(declared, offered), F.array_except(offered, declared)
    number = lambda side, p: F.expr(f"try_cast({side}['{p}'] as double)")
    near = lambda a, b: F.abs(a - b) <= F.greatest(F.lit(1e-9) * F.greatest(F.abs(a), F.abs(b)), F.lit(1e-12))
    points_mode = F.upper(F.coalesce(s("swap.mode"), F.lit(""))) == "POINTS"
    swap = [
        F.when(points_mode, F.when(m(p).isNull() | is_placeholder(m(p)), _finding(p, m(p), s(q), PENDENTE, "not filled in")).when(~F.coalesce(near(number("m", p), number("s", q)), F.lit(False)), _finding(p, m(p), s(q), ERRO, "differs")))
        for p, q in (("swap.buy_points", "swap.long"), ("swap.sell_points", "swap.short"))
    ]
    demo_server = F.lower(F.coalesce(s("account.source"), F.lit(""))) != "real"
    is_demo = F.expr("try_cast(m['is_demo'] as boolean)")
    point, digits = number("s", "specs.point"), number("s", "specs.digits")
    found = [
        *(_field(*f) for f in FIELDS),
        F.when(~F.array_contains(_items("m", "symbol.resolve"), F.coalesce(s("symbol"), F.lit(""))), _finding("symbol.resolve", m("symbol.resolve"), s("symbol"), ERRO, "symbol is not among the names")),
        F.when(F.size(lost) > 0, _finding("execution.filling", F.concat_ws("|", declared), F.concat_ws("|", lost), ERRO, "declared, not offered")),
        F.when(F.size(extra) > 0, _finding("execution.filling", F.concat_ws("|", declared), F.concat_ws("|", extra), INFO, "offered, not declared")),
        F.when(~points_mode, _finding("swap.mode", F.lit("POINTS"), s("swap.mode"), ERRO, "swap is not in points: sides not compared")),
        *swap,
        F.when(m("swap.triple_day").isNotNull() & ~is_placeholder(m("swap.triple_day")) & ~F.coalesce(F.lower(F.trim(m("swap.triple_day"))) == F.lower(F.trim(s("swap.rollover3days"))), F.lit(False)), _finding("swap.triple_day", m("swap.triple_day"), s("swap.rollover3days"), ERRO, "differs")),
        F.when(is_demo.isNotNull() & (is_demo != demo_server), _finding("is_demo", m("is_demo"), s("account.source"), ERRO, "other kind of account")),
        F.when(~F.coalesce(near(point, F.pow(F.lit(10.0), -digits)), F.lit(False)), _finding("specs.point", F.pow(F.lit(10.0), -digits).cast("string"), s("specs.point"), ERRO, "point is not 10^-digits")),
        F.when(~F.coalesce(near(number("s", "specs.trade_tick_size"), point), F.lit(True)), _finding("specs.trade_tick_size", s("specs.point"), s("specs.trade_tick_size"), INFO, "tick size is not the point")),
    ]
    rows = both.withColumn("__ok", F.coalesce(wrong.cast("boolean"), F.lit(True))).where("__ok").select("doc", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("f")).select("doc", "f.*")
    return rows.orderBy("doc", F.expr(f"array_position(array('{ERRO}', '{PENDENTE}', '{INFO}'), severidade)"), "campo")


def counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("severidade").agg(F.count("*").alias("n"))


def human_numbers(docs: DataFrame) -> DataFrame:
    """Per document: a point's and a tick's worth, the swap a night in USD per ounce by side, and the current spread."""
    s = _pick(docs, "specs")
    n = lambda p: F.expr(f"try_cast(s['{p}'] as double)")
    point = F.pow(F.lit(10.0), -n("specs.digits"))
    return s.select(
        "doc", point.alias("point_usd_oz"), (n("specs.trade_contract_size") * point).alias("point_usd_lot"), (-n("swap.long") * point + 0.0).alias("swap_buy_usd_oz"),
        (-n("swap.short") * point + 0.0).alias("swap_sell_usd_oz"), (n("instantaneo.ask") - n("instantaneo.bid")).alias("spread_usd_oz"),
    )
