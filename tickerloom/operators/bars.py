"""Latest bar and previous close per symbol, from the four price inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions.dates import as_of_time, first_epoch_day, strict_day
from tickerloom.functions.numbers import first_raw, first_truthy, nan_as_null, number, whole_volume
from tickerloom.functions.reports import price_change, price_change_percent
from tickerloom.operators.ranking import top_per_key
from tickerloom.sources.files import require_columns

OHLCV = ["Open", "High", "Low", "Close", "Volume"]
BAR_COLUMNS = [
    "symbol", "exchange", "open", "high", "low", "price", "volume", "latest_day",
    "previous_close", "change", "change_percent",
]


def optional(frame: DataFrame, name: str, default=None, kind: str = "string") -> Column:
    """The column if the file has it, else a constant."""
    return F.col(f"`{name}`") if name in frame.columns else F.lit(default).cast(kind)


def bulk_bars(prices: DataFrame) -> DataFrame:
    """Normalise the keys of bulk price rows; measures stay text until the rows are few.

    A row without a day cannot be placed in time and is left out; a day that is no date fails.
    """
    require_columns(prices, "Ticker", "Date")
    measures = ["Open", "High", "Low", "Close", "Adj. Close", "Volume"]
    taken = {"Ticker", "Date", "DateTime", "Timestamp", *measures}
    return prices.where(F.col("Ticker").isNotNull() & F.col("Date").isNotNull()).select(
        F.upper("Ticker").alias("symbol"),
        strict_day(F.col("Date")).alias("latest_day"),
        as_of_time(prices.columns).alias("as_of"),
        *(optional(prices, m).alias(m) for m in measures),
        *(c for c in prices.columns if c not in taken),
    )


def latest_bar(bars: DataFrame, position: list[str]) -> DataFrame:
    """The last row per symbol by day, then time, then landed position.

    Within a day a row without a time counts as the latest, as in a sort that puts nulls last.
    """
    return top_per_key(bars, ["symbol"], _latest_order(position))


def _landed_last(position: list[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in position]


def _latest_order(position: list[str]) -> list[Column]:
    return [F.col("latest_day").desc(), F.col("as_of").desc_nulls_first(), *_landed_last(position)]


def last_two_bars(bars: DataFrame, position: list[str]) -> DataFrame:
    """Newest and second-newest row per symbol by day and landed position, ranked 1 and 2."""
    order = [F.col("latest_day").desc(), *_landed_last(position)]
    return top_per_key(bars, ["symbol"], order, k=2, rank="age")


def previous_close(bars: DataFrame, position: list[str]) -> DataFrame:
    """Per symbol the close of its second-newest row, null where there is one row only."""
    older = F.when(F.col("age") == 2, F.coalesce(F.col("Close"), F.col("`Adj. Close`")))
    texts = last_two_bars(bars, position).groupBy("symbol").agg(F.max(older).alias("close"))
    return texts.select("symbol", number(F.col("close")).alias("previous_close"))


def _whole_bar() -> Column:
    return F.struct("latest_day", "as_of", *(F.col(f"`{c}`") for c in [*OHLCV, "Adj. Close"]))


def latest_only(bars: DataFrame, position: list[str]) -> DataFrame:
    """:func:`latest_bar` in the shape of :func:`latest_with_previous`, no previous close.

    The closing group-by keeps Catalyst from moving a later semi join below the ranking, where
    it would shuffle the raw rows, unless the join's other side is small enough to broadcast.
    """
    return (
        latest_bar(bars, position)
        .groupBy("symbol")
        .agg(F.max(_whole_bar()).alias("bar"))
        .select("symbol", "bar.*", F.lit(None).cast("double").alias("previous_close"))
    )


#: Stands between the texts of a packed bar, and the codes for what a text may hold of it.
_SEP, _CODES = "\x1f", (("\\", "\\b"), ("\x1f", "\\s"))


def _packed(names: list[str]) -> Column:
    """Texts as one text, which takes a third less room in a sort; nulls, separators and backslashes are coded."""

    def coded(x: Column) -> Column:
        for plain, code in _CODES:
            x = F.replace(x, F.lit(plain), F.lit(code))
        return F.coalesce(x, F.lit("\\n"))

    return F.concat_ws(_SEP, *(coded(F.col(f"`{name}`")) for name in names))


def _unpacked(packed: Column, names: list[str]) -> list[Column]:
    """The texts of :func:`_packed`."""

    def plain(x: Column) -> Column:
        x = F.nullif(x, F.lit("\\n"))
        for text, code in reversed(_CODES):
            x = F.replace(x, F.lit(code), F.lit(text))
        return x

    texts = F.transform(F.split(packed, _SEP, -1), plain)
    return [F.get(texts, F.lit(i)).alias(name) for i, name in enumerate(names)]


def latest_with_previous(bars: DataFrame, position: list[str], timed: bool) -> DataFrame:
    """:func:`latest_bar` plus :func:`previous_close`.

    Without bar times both follow the same order and share one ranking. With them the two orders differ
    among a day's rows that have a time, so those are ranked in both, as two rows of one scan; among rows
    without a time the orders agree, and they are ranked once. Each ranking is cut to two rows a symbol
    before the shuffle, however many bars a day has; the few rows left of a symbol settle both.
    """
    close = F.coalesce(F.col("Close"), F.col("`Adj. Close`"))
    measures = [*OHLCV, "Adj. Close"]
    if not timed:
        newest, older = F.col("age") == 1, F.col("age") == 2
        return (
            last_two_bars(bars, position)
            .groupBy("symbol")
            .agg(F.max(F.when(newest, _whole_bar())).alias("bar"), F.max(F.when(older, close)).alias("close"))
            .select("symbol", "bar.*", number(F.col("close")).alias("previous_close"))
        )
    way, both, by_place, by_time = F.col("way"), F.lit(0), F.lit(1), F.lit(2)
    ways = F.explode(F.when(F.col("as_of").isNull(), F.array(both)).otherwise(F.array(by_place, by_time)))
    rows = bars.withColumn("way", ways).select(
        "symbol", "way", "latest_day", F.when(way != by_place, F.col("as_of")).alias("as_of"), *position,
        F.when(way != by_time, close).alias("close"), F.when(way != by_place, _packed(measures)).alias("texts"),
    )
    rows = top_per_key(rows, ["symbol", "way"], _latest_order(position), k=2)
    place = F.when(way != by_time, F.struct("latest_day", *position, "close"))
    time = F.when(way != by_place, F.struct("latest_day", F.col("as_of").isNull().alias("untimed"), "as_of", *position))
    found = rows.groupBy("symbol").agg(
        F.max(time).alias("newest"), F.max_by("texts", time).alias("texts"), F.sort_array(F.collect_list(place), asc=False).alias("landed")
    )
    previous = F.get(F.col("landed"), F.lit(1))["close"]
    return found.select("symbol", "newest.latest_day", "newest.as_of", *_unpacked(F.col("texts"), measures), number(previous).alias("previous_close"))


def with_change(bars: DataFrame) -> DataFrame:
    """Add change and percent against ``previous_close``."""
    price, previous = F.col("price"), F.col("previous_close")
    return bars.withColumns(
        {"change": price_change(price, previous), "change_percent": price_change_percent(price, previous)}
    )


def require_price(bars: DataFrame) -> DataFrame:
    return bars.where(F.col("price").isNotNull())


def bulk_to_bars(latest: DataFrame, exchange: str = "US") -> DataFrame:
    """Typed bar rows from reduced bulk rows; a row without a price stays until :func:`require_price`."""
    typed = latest.select(
        "symbol",
        F.lit(exchange).alias("exchange"),
        number(F.col("Open")).alias("open"),
        number(F.col("High")).alias("high"),
        number(F.col("Low")).alias("low"),
        first_raw(F.col("Close"), F.col("`Adj. Close`")).alias("price"),
        whole_volume(number(F.col("Volume"))).alias("volume"),
        "latest_day",
        "as_of",
        "previous_close",
    )
    return with_change(typed)


def quote_bars(quotes: DataFrame) -> DataFrame:
    """Quotes -> bars; a quote without price or time gives none."""
    day = first_epoch_day(F.col("regularMarketTime"), F.col("postMarketTime"), F.col("preMarketTime"))
    typed = quotes.select(
        F.col("symbol").alias("vendor_symbol"),
        F.col("regularMarketOpen").alias("open"),
        F.col("regularMarketDayHigh").alias("high"),
        F.col("regularMarketDayLow").alias("low"),
        F.col("regularMarketPrice").alias("price"),
        whole_volume(F.col("regularMarketVolume")).alias("volume"),
        day.alias("latest_day"),
        F.col("regularMarketPreviousClose").alias("previous_close"),
    )
    return with_change(require_price(typed).where("latest_day is not null"))


def fast_info_bars(infos: DataFrame, today: Column) -> DataFrame:
    """Fast-info payload fields -> bars without change columns; no time means ``today``."""
    c = F.col
    day = first_epoch_day(c("regularMarketTime"), c("lastMarketTime"))
    typed = infos.select(
        c("symbol").alias("vendor_symbol"),
        # NaN is a value to the "first truthy" rule, and missing only after it.
        nan_as_null(c("open")).alias("open"),
        nan_as_null(first_truthy(c("dayHigh"), c("regularMarketDayHigh"))).alias("high"),
        nan_as_null(first_truthy(c("dayLow"), c("regularMarketDayLow"))).alias("low"),
        nan_as_null(first_truthy(c("lastPrice"), c("last_price"), c("regularMarketPrice"))).alias("price"),
        first_truthy(c("lastVolume"), c("regularMarketVolume")).alias("volume"),
        F.coalesce(day, today).alias("latest_day"),
    )
    return require_price(typed)


def last_history_bar(history: DataFrame, position: list[str]) -> DataFrame:
    """The last landed row per symbol, whatever its values."""
    return top_per_key(history, ["symbol"], [F.col("date").desc(), *_landed_last(position)])


def history_bars(history: DataFrame, position: list[str]) -> DataFrame:
    """Last history row -> bar; none when that row has no close."""
    typed = last_history_bar(history, position).select(
        F.col("symbol").alias("vendor_symbol"),
        nan_as_null(F.col("Open")).alias("open"),
        nan_as_null(F.col("High")).alias("high"),
        nan_as_null(F.col("Low")).alias("low"),
        nan_as_null(F.col("Close")).alias("price"),
        whole_volume(nan_as_null(F.col("Volume").cast("double"))).alias("volume"),
        F.col("date").alias("latest_day"),
    )
    return require_price(typed)


def first_source_bars(fast: DataFrame, history: DataFrame) -> DataFrame:
    """The fast-info bar of a symbol, else its history bar.

    The choice comes before any newness check: a stale fast-info bar does not fall back.
    """
    bar = ["open", "high", "low", "price", "volume", "latest_day"]
    left = fast.select("vendor_symbol", F.struct(*bar).alias("fast"))
    right = history.select("vendor_symbol", F.struct(*bar).alias("hist"))
    chosen = F.coalesce("fast", "hist")
    return left.join(right, "vendor_symbol", "full").select("vendor_symbol", chosen.alias("bar")).select("vendor_symbol", "bar.*")


def drop_empty_bars(bars: DataFrame) -> DataFrame:
    """Drop rows in which all five measures are null."""
    return bars.dropna(how="all", subset=OHLCV)


def panel_bars(long: DataFrame, day: str = "date", position: tuple[str, ...] = ()) -> DataFrame:
    """Long panel rows -> one bar per ticker.

    Of repeated days the last landed row by ``position`` comes first, then by its values, so that a
    ticker in two overlapping panels gives the same bar in every run.

    Takes the last two days of a ticker first and drops empty rows after that, so a ticker whose
    newest day is empty falls back one day and then has no previous close.
    """
    ties = [F.col(name).desc_nulls_last() for name in (*position, "Close", "Volume", "High", "Low", "Open")]
    window = Window.partitionBy("ticker").orderBy(F.col(day).desc(), *ties)
    recent = long.withColumn("age", F.row_number().over(window)).where("age <= 2")
    bar = F.struct(*OHLCV, F.col(day).alias("latest_day"))
    reduced = drop_empty_bars(recent).groupBy("ticker").agg(
        F.min_by(bar, "age").alias("bar"),
        F.max_by("Close", "age").alias("oldest_close"),
        F.count("*").alias("rows"),
    )
    typed = reduced.select(
        F.col("ticker").alias("vendor_symbol"),
        nan_as_null(F.col("bar.Open")).alias("open"),
        nan_as_null(F.col("bar.High")).alias("high"),
        nan_as_null(F.col("bar.Low")).alias("low"),
        nan_as_null(F.col("bar.Close")).alias("price"),
        whole_volume(nan_as_null(F.col("bar.Volume").cast("double"))).alias("volume"),
        "bar.latest_day",
        F.when(F.col("rows") == 2, nan_as_null(F.col("oldest_close"))).alias("previous_close"),
    )
    return with_change(require_price(typed))
