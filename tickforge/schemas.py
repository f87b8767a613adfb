"""Tables of the engine. Times are microseconds since the epoch in UTC (LONG): no session zone can move them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


STR, LONG, DBL, FLT, INT, BOOL = T.StringType(), T.LongType(), T.DoubleType(), T.FloatType(), T.IntegerType(), T.BooleanType()

#: `seq` is the input order: ties within a timestamp are common and first/last depend on it.
TICK = _struct(instrument=STR, ts_us=LONG, seq=LONG, bid=DBL, ask=DBL, bid_vol=FLT, ask_vol=FLT)
BAR = _struct(instrument=STR, timeframe=STR, ts_us=LONG, open=DBL, high=DBL, low=DBL, close=DBL, range_usd_oz=DBL, n_ticks=LONG)
CANDLE = _struct(instrument=STR, ts_us=LONG, open=DBL, high=DBL, low=DBL, close=DBL, volume=FLT)
ENTRY = _struct(entry_id=LONG, ts_us=LONG, side=STR)
DEAL = _struct(ts_utc=STR, side=STR, symbol=STR, volume=DBL, preco_abertura=DBL, ts_servidor=STR)
SENSOR = _struct(instrument=STR, ts_us=LONG, seq=LONG, tr=LONG, rg=DBL, dsp=DBL, er=DBL, caminho=DBL)
#: The fields of a log row, in the order in which they are written.
LOG = _struct(**dict.fromkeys(["ts", "ts_srv", "run_id", "build_hash", "config_hash", "src", "comp", "lvl", "account_hash", "feed_id", "broker_id"], STR))

#: The fields of a terminal's report, as it writes them.
SPECS = _struct(
    schema=STR, run_id=STR, lido_em_utc=STR, terminal_build=INT, symbol=STR,
    account=_struct(hash=STR, source=STR, company=STR, server=STR, currency=STR, margin_mode=STR, margin_mode_raw=INT),
    specs=_struct(
        digits=INT, point=DBL, trade_contract_size=DBL, trade_tick_value=DBL, trade_tick_value_profit=DBL, trade_tick_value_loss=DBL, trade_tick_size=DBL,
        trade_stops_level=INT, trade_freeze_level=INT, trade_mode=STR, trade_calc_mode=STR, volume_min=DBL, volume_max=DBL, volume_step=DBL,
        filling_mode=T.ArrayType(STR), filling_mode_raw=INT, currency_base=STR, currency_profit=STR, currency_margin=STR,
    ),
    swap=_struct(long=DBL, short=DBL, mode=STR, mode_raw=INT, rollover3days=STR, rollover3days_raw=INT),
    instantaneo=_struct(bid=DBL, ask=DBL, spread_points=INT, spread_float=BOOL, spread_derivado_por_digits=DBL),
)
SPECS_ID = "symbol-specs/1"

#: Seconds by timeframe name.
TIMEFRAMES = {"M1": 60, "M5": 300, "M15": 900, "M30": 1800}


@dataclass(frozen=True)
class InstrumentSpec:
    name: str
    price_decimals: int
    unit: str = "usd_oz"
    plausible_range: tuple[float, float] = (0.0, float("inf"))

    @property
    def divisor(self) -> float:
        return float(10**self.price_decimals)


@dataclass(frozen=True)
class OvernightCost:
    """Cost a night in USD per ounce by side; charged at `rollover_hour`, three times on `triple_weekday` (Monday 0), never at weekends."""

    buy: float
    sell: float
    triple_weekday: int | None = None
    rollover_hour: int = 21


@dataclass(frozen=True)
class FeedConfig:
    base_url: str
    path_template: str
    history_starts: dict[str, int] = field(default_factory=dict)
