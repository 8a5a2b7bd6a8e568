"""Technical indicators as features of a bar series (columns high, low, close, volume).

Variants that differ in seed, divisor or missing-value rule are separate functions.
Undefined ratios (x/0) are NULL, except that an RSI without losses is 100.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.recurrence import ema, wilder
from tickloom.functions.window import (
    Source,
    derived,
    diff,
    rolling_max,
    rolling_mean,
    rolling_min,
    rolling_std,
    shift,
    source,
)
from tickloom.plans import Feature, Running


def _code(*parts: object) -> str:
    """Parameters as part of a column name, which may not hold a dot."""
    return "_".join(str(p).replace(".", "p") for p in parts)


def _ratio_index(gain: Column, loss: Column) -> Column:
    """100 - 100 / (1 + gain/loss); 100 when only gains, NULL when neither."""
    return F.when(loss == 0, F.when(gain != 0, 100.0)).otherwise(
        100.0 - F.try_divide(F.lit(100.0), 1.0 + F.try_divide(gain, loss))
    )


def _moves(close: str, first_zero: bool) -> tuple[Feature, Feature]:
    """Upward and downward parts of the price change, both >= 0."""
    d = diff(close)
    x = F.col(d.name)
    up, down = F.greatest(x, F.lit(0.0)), F.greatest(-x, F.lit(0.0))
    if first_zero:
        return (derived(f"_up0_{close}", F.when(x > 0, x).otherwise(0.0), d),
                derived(f"_down0_{close}", F.when(x < 0, -x).otherwise(0.0), d))
    return (derived(f"_up_{close}", F.when(x.isNotNull(), up), d),
            derived(f"_down_{close}", F.when(x.isNotNull(), down), d))


def rsi_sma(close: str = "close", n: int = 14, first_delta_zero: bool = False) -> Feature:
    """RSI over simple means; with ``first_delta_zero`` the first change counts as 0."""
    up, down = (rolling_mean(m, n) for m in _moves(close, first_delta_zero))
    name = "rsi_sma0" if first_delta_zero else "rsi_sma"
    index = _ratio_index(F.col(up.name), F.col(down.name))
    return derived(f"_{name}_{n}_{close}", index, up, down).named(name)


def rsi_signed(close: str = "close", n: int = 14) -> Feature:
    """RSI variant whose mean loss keeps its negative sign; not bounded by 0..100."""
    up, down = (rolling_mean(m, n) for m in _moves(close, False))
    index = _ratio_index(F.col(up.name), -F.col(down.name))
    return derived(f"_rsi_signed_{n}_{close}", index, up, down).named("rsi_signed")


def rsi_wilder(close: str = "close", n: int = 14) -> Feature:
    """RSI over Wilder means, the first change counting as 0; 100 when the mean loss is 0."""
    up, down = (wilder(m, n) for m in _moves(close, True))
    g, l = F.col(up.name), F.col(down.name)
    index = F.when(l == 0, 100.0).otherwise(100.0 - 100.0 / (1.0 + F.try_divide(g, l)))
    return derived(f"_rsi_wilder_{n}_{close}", index, up, down).named("rsi_wilder")


def _macd(close: str, fast: int, slow: int, warm: bool) -> Feature:
    a, b = (ema(close, span, span if warm else 0) for span in (fast, slow))
    name = f"_macd{'_warm' if warm else ''}_{fast}_{slow}_{close}"
    return derived(name, F.col(a.name) - F.col(b.name), a, b)


def macd(close: str = "close", fast: int = 12, slow: int = 26) -> Feature:
    return _macd(close, fast, slow, warm=False).named("macd")


def macd_signal(close: str = "close", fast: int = 12, slow: int = 26, n: int = 9) -> Feature:
    return ema(_macd(close, fast, slow, warm=False), n).named("macd_signal")


def macd_ta(
    close: str = "close", fast: int = 12, slow: int = 26, n: int = 9
) -> tuple[Feature, Feature, Feature]:
    """Line, signal and histogram with warm-up NULLs; the signal starts at the first line value."""
    line = _macd(close, fast, slow, warm=True)
    signal = ema(line, n, n)
    hist = derived(f"_hist{n}{line.name}", F.col(line.name) - F.col(signal.name), line, signal)
    return line.named("macd_line"), signal.named("macd_line_signal"), hist.named("macd_hist")


def bollinger(
    close: str = "close", n: int = 20, k: float = 2.0, ddof: int = 1
) -> tuple[Feature, Feature, Feature]:
    """Middle, upper and lower band; ``ddof=0`` uses the population deviation."""
    mean, dev = rolling_mean(close, n), rolling_std(close, n, ddof)
    tag = "bb" if ddof else "bbp"
    mid, width = F.col(mean.name), F.lit(k) * F.col(dev.name)
    code = _code(n, k, close)
    return (
        derived(f"_{tag}_middle_{code}", mid, mean).named(f"{tag}_middle"),
        derived(f"_{tag}_upper_{code}", mid + width, mean, dev).named(f"{tag}_upper"),
        derived(f"_{tag}_lower_{code}", mid - width, mean, dev).named(f"{tag}_lower"),
    )


def band_position(close: str = "close", n: int = 20, k: float = 2.0) -> Feature:
    """Where the price lies between the lower (0) and upper (1) population band."""
    mean, dev = rolling_mean(close, n), rolling_std(close, n, 0)
    width = F.lit(k) * F.col(dev.name)
    low, high = F.col(mean.name) - width, F.col(mean.name) + width
    position = F.try_divide(F.col(close) - low, high - low)
    return derived(f"_band_{_code(n, k, close)}", position, mean, dev).named("band_position")


def stochastic(
    high: str = "high", low: str = "low", close: str = "close", n: int = 14, smooth: int = 3
) -> tuple[Feature, Feature]:
    hi, lo = rolling_max(high, n), rolling_min(low, n)
    floor = F.col(lo.name)
    k = derived(
        f"_stochastic_{n}_{high}_{low}_{close}",
        F.lit(100.0) * F.try_divide(F.col(close) - floor, F.col(hi.name) - floor),
        hi, lo,
    )
    return k.named("stochastic_k"), rolling_mean(k, smooth).named("stochastic_d")


def moving_average(close: str = "close", n: int = 50) -> Feature:
    return rolling_mean(close, n).named(f"moving_average_{n}")


def momentum(close: str = "close", n: int = 10) -> Feature:
    past = shift(close, n)
    change = F.col(close) - F.col(past.name)
    return derived(f"_momentum_{n}_{close}", change, past).named("momentum")


def roc(close: str = "close", n: int = 10) -> Feature:
    past = shift(close, n)
    change = F.lit(100.0) * (F.try_divide(F.col(close), F.col(past.name)) - 1.0)
    return derived(f"_roc_{n}_{close}", change, past).named("roc")


def true_range(
    high: str = "high", low: str = "low", close: str = "close", signed: bool = False
) -> Feature:
    """Largest of H-L and the distances to the previous close; H-L in the first row."""
    prev = shift(close, 1)
    h, l, c = F.col(high), F.col(low), F.col(prev.name)
    size = (lambda x: x) if signed else F.abs
    name = "_tr_signed" if signed else "_tr"
    return derived(f"{name}_{high}_{low}_{close}", F.greatest(h - l, size(h - c), size(l - c)), prev)


def atr_sma(n: int = 14) -> Feature:
    return rolling_mean(true_range(), n).named("atr_sma")


def atr_unsigned(n: int = 14) -> Feature:
    """Variant taking the distances to the previous close without absolute value."""
    return rolling_mean(true_range(signed=True), n).named("atr_unsigned")


def atr_wilder(n: int = 14) -> Feature:
    return wilder(true_range(), n, seeded=True).named("atr_wilder")


def avg_volume(volume: str = "volume", n: int = 50) -> Feature:
    return rolling_mean(volume, n).named("avg_volume")


def vwap(price: str = "close", volume: str = "volume") -> Feature:
    """Traded value over traded volume since the start of the series."""
    value = Running(f"_value_{price}_{volume}", "sum", F.col(price) * F.col(volume))
    total = Running(f"_sum_{volume}", "sum", F.col(volume))
    ratio = F.try_divide(F.col(value.name), F.col(total.name))
    return derived(f"_vwap_{price}_{volume}", ratio, value, total).named("vwap")


def _mid_range(high: str, low: str, n: int) -> Feature:
    hi, lo = rolling_max(high, n), rolling_min(low, n)
    return derived(f"_mid{n}_{high}_{low}", (F.col(hi.name) + F.col(lo.name)) / 2.0, hi, lo)


def ichimoku(
    high: str = "high", low: str = "low", n1: int = 9, n2: int = 26, n3: int = 52
) -> tuple[Feature, Feature, Feature, Feature]:
    """Leading spans a and b, base line and conversion line (no forward shift)."""
    conversion, base, b = (_mid_range(high, low, n) for n in (n1, n2, n3))
    middle = (F.col(conversion.name) + F.col(base.name)) / 2.0
    a = derived(f"_span{conversion.name}{base.name}", middle, conversion, base)
    return (a.named("ichimoku_a"), b.named("ichimoku_b"),
            base.named("ichimoku_base"), conversion.named("ichimoku_conversion"))


def adx(n: int = 14, high: str = "high", low: str = "low") -> tuple[Feature, Feature, Feature]:
    """Directional index and the positive and negative directional indicators."""
    up, down = diff(high), diff(low)
    u, d = F.col(up.name), -F.col(down.name)
    code = f"{high}_{low}"
    plus = derived(f"_dm_plus_{code}", F.when((u > d) & (u > 0), u).otherwise(0.0), up, down)
    minus = derived(f"_dm_minus_{code}", F.when((d > u) & (d > 0), d).otherwise(0.0), up, down)
    p, m, t = wilder(plus, n), wilder(minus, n), wilder(true_range(high, low), n)
    pos = derived(f"_di_plus_{n}_{code}", 100.0 * F.try_divide(F.col(p.name), F.col(t.name)), p, t)
    neg = derived(f"_di_minus_{n}_{code}", 100.0 * F.try_divide(F.col(m.name), F.col(t.name)), m, t)
    a, b = F.col(pos.name), F.col(neg.name)
    dx = derived(f"_dx_{n}_{code}", 100.0 * F.try_divide(F.abs(a - b), a + b), pos, neg)
    return wilder(dx, n, seeded=True).named("adx"), pos.named("adx_pos"), neg.named("adx_neg")


def cci(n: int = 20, high: str = "high", low: str = "low", close: str = "close") -> Feature:
    """Distance of the typical price from its mean in units of its mean absolute deviation."""
    code = f"{high}_{low}_{close}"
    typical = derived(f"_typical_{code}", (F.col(high) + F.col(low) + F.col(close)) / 3.0)
    mean = rolling_mean(typical, n)

    def frame_values(w: WindowSpec) -> Column:
        return F.collect_list(typical.name).over(w.rowsBetween(1 - n, Window.currentRow))

    values = Feature(f"_typicals{n}_{code}", frame_values, (typical,), back=n - 1)
    centre = F.col(mean.name)
    spread = F.aggregate(
        F.col(values.name), F.lit(0.0), lambda total, x: total + F.abs(x - centre)
    ) / n
    distance = F.try_divide(F.col(typical.name) - centre, 0.015 * spread)
    return derived(f"_cci_{n}_{code}", distance, typical, mean, values).named("cci")


def smoothed(x: Source, span: int) -> Feature:
    """EMA level under the usual name."""
    c, _ = source(x)
    return ema(c, span).named(f"ema_{span}")
