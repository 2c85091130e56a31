"""Transactions of an account within a time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwarden.functions.skew import (
    DEFAULT_SKEW,
    KeyProfile,
    SkewSettings,
    attach,
    count_per_key,
    profile_keys,
)
from txwarden.functions.staging import quoted
from txwarden.operators.temporal import micros_between

EPOCH = "1970-01-01 00:00:00"
DAY_MICROS = 86_400_000_000
MINUTE_MICROS = 60_000_000


def clock_micros(time: str, origin: str = EPOCH) -> Column:
    """Microseconds since ``origin`` on the wall clock, exact."""
    return micros_between(F.lit(origin).cast("timestamp_ntz"), F.col(time))


def bin_origin(df: DataFrame, time: str, hours: int) -> str:
    """Bins start at midnight of the first day. When the width divides the day every
    midnight starts a bin and no look at the data is needed."""
    if 24 % hours == 0:
        return EPOCH
    first = df.agg(F.date_trunc("day", F.min(time)).cast("string")).first()[0]
    return first or EPOCH


def bin_number(time: str, hours: int, origin: str = EPOCH) -> Column:
    micros, width = clock_micros(time, origin), hours * 3_600_000_000
    return ((micros - F.pmod(micros, F.lit(width))) / width).cast("long")


def with_velocity(
    df: DataFrame,
    mode: str = "bin",
    hours: int = 24,
    account: str = "accountNumber",
    time: str = "transactionTime",
    row_key: str = "eventId",
    skew: SkewSettings = DEFAULT_SKEW,
    origin: str | None = None,
) -> DataFrame:
    """transaction_velocity per account and window; null for a missing account or time.

    ``bin``: size of the row's own tumbling window. ``literal``: the same, but only on rows
    whose time is exactly the start of a window. ``trailing``: rows in the ``hours`` up to
    and including the row's time. ``origin`` is where bins start, found in ``df`` by default.
    """
    name = "transaction_velocity"
    if mode == "trailing":
        return _trailing(df, hours, account, time, row_key, skew, name)
    if mode not in ("bin", "literal"):
        raise ValueError(f"unknown velocity mode {mode!r}")
    origin = origin or bin_origin(df, time, hours)
    binned = df.withColumn("_bin", bin_number(time, hours, origin))
    (profile,) = profile_keys(binned, [account, "_bin"], settings=skew)
    counts = count_per_key(binned, [account, "_bin"], name)
    out = attach(binned, counts, profile, [row_key])
    if mode == "literal":
        out = out.withColumn(name, F.when(starts_bin(time, hours, origin), F.col(name)))
    return out.select(*map(quoted, df.columns), name)


def starts_bin(time: str, hours: int, origin: str = EPOCH) -> Column:
    return F.pmod(clock_micros(time, origin), F.lit(hours * 3_600_000_000)) == 0


def _trailing(df, hours, account, time, row_key, skew, name) -> DataFrame:
    (profile,) = profile_keys(df, [account], settings=skew)
    timed = df.withColumn("_us", clock_micros(time))
    width = hours * 3_600_000_000
    known = ~profile.has_null & F.col("_us").isNotNull()
    plain, hot = profile.split(timed)
    window = Window.partitionBy(account).orderBy("_us").rangeBetween(-width, 0)
    parts = [
        plain.where(known).withColumn(name, F.count(F.lit(1)).over(window)),
        timed.where(~known).withColumn(name, F.lit(None).cast("long")),
    ]
    if profile.hot:
        parts.append(_trailing_hot(hot.where(known), width, account, row_key, skew, name))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*map(quoted, df.columns), name)


def _trailing_hot(timed, width, account, row_key, skew, name) -> DataFrame:
    """A row enters the window at its time and leaves just after ``width``, so the wanted
    count is a running sum of entries minus exits, which can be cut by minute."""
    moments = timed.groupBy(account, "_us").agg(F.count(F.lit(1)).alias("_d"))
    steps = (
        moments.select(
            account,
            F.explode(
                F.array(
                    F.struct(F.col("_us"), F.col("_d")),
                    F.struct((F.col("_us") + width + 1).alias("_us"), (-F.col("_d")).alias("_d")),
                )
            ).alias("s"),
        )
        .select(account, "s._us", "s._d")
        .groupBy(account, "_us")
        .agg(F.sum("_d").alias("_d"))
    )
    running = running_sum_by_minute(steps, account, "_us", "_d", name)
    (profile,) = profile_keys(timed, [account, "_us"], settings=skew)
    return attach(timed, running, profile, [row_key])


def running_sum_by_minute(
    df: DataFrame, account: str, micros: str, value: str, name: str
) -> DataFrame:
    """Running sum per account over distinct times. An account-minute holds at most 6e7
    microseconds and an account one total per minute, which bounds every window group."""
    cut = df.withColumn("_m", F.floor(F.col(micros) / MINUTE_MICROS))
    totals = cut.groupBy(account, "_m").agg(F.sum(value).alias("_t"))
    before = Window.partitionBy(account).orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(account, "_m", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_t"))
    upto = Window.partitionBy(account, "_m").orderBy(micros)
    return (
        cut.withColumn("_s", F.sum(value).over(upto))
        .join(totals, [account, "_m"])
        .select(account, micros, (F.col("_s") + F.col("_t")).alias(name))
    )


def account_window_features(
    df: DataFrame,
    profile: KeyProfile,
    velocity_mode: str = "bin",
    hours: int = 24,
    account: str = "accountNumber",
    category: str = "mcc",
    time: str = "transactionTime",
    row_key: str = "eventId",
    skew: SkewSettings = DEFAULT_SKEW,
) -> DataFrame:
    """Account frequency, velocity, category frequency and gap in one shuffle by account.

    Grouping by account also groups (account, window) and (account, category), so the four
    windows share one exchange. Rows of hot accounts go through the separate operators,
    which aggregate first; rows without an account need no shuffle at all.
    """
    from txwarden.operators.frequency import with_key_frequency, with_pair_frequency
    from txwarden.operators.gaps import gap_to_previous, with_gap

    names = [
        f"{account}_freq",
        "transaction_velocity",
        "merchant_category_frequency",
        "time_since_last_transaction",
    ]
    if velocity_mode not in ("bin", "literal"):
        out = with_key_frequency(df, [account], row_key, skew, [profile])
        out = with_velocity(out, velocity_mode, hours, account, time, row_key, skew)
        out = with_pair_frequency(out, [account, category], names[2], row_key, skew)
        return with_gap(out, account, time, row_key, skew).select(*map(quoted, df.columns), *names)

    origin = bin_origin(df, time, hours)
    rows = F.count(F.lit(1))
    velocity = F.when(
        F.col(time).isNotNull(), rows.over(Window.partitionBy(account, "_bin"))
    )
    if velocity_mode == "literal":
        velocity = F.when(starts_bin(time, hours, origin), velocity)
    plain, hot = profile.split(df)
    ordinary = (
        plain.where(~profile.has_null)
        .withColumn("_bin", bin_number(time, hours, origin))
        .withColumns(
            {
                names[0]: rows.over(Window.partitionBy(account)),
                names[1]: velocity,
                names[2]: F.when(
                    F.col(category).isNotNull(),
                    rows.over(Window.partitionBy(account, category)),
                ),
                names[3]: gap_to_previous(account, time, row_key),
            }
        )
        .drop("_bin")
    )
    out = ordinary
    if profile.hot:
        hot = with_key_frequency(hot, [account], row_key, skew)
        hot = with_velocity(hot, velocity_mode, hours, account, time, row_key, skew, origin)
        hot = with_pair_frequency(hot, [account, category], names[2], row_key, skew)
        out = out.unionByName(with_gap(hot, account, time, row_key, skew))
    if profile.nulls:
        types = {f.name: f.dataType for f in ordinary.schema}
        unknown = df.where(profile.has_null).withColumns(
            {name: F.lit(None).cast(types[name]) for name in names}
        )
        out = out.unionByName(unknown)
    return out.select(*map(quoted, df.columns), *names)
