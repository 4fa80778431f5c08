"""Line parsing as native column expressions (no UDF, usable on batch and stream).

A line is one text row without its newline. Every line gets a ``format``:
``rfc5424``, ``rfc3164``, ``fallback``, ``invalid`` (no match or only white space)
or ``blank`` (zero length).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsieve import fixed_values as V

# Every character that counts as white space when a line is trimmed.
_SPACES = (
    "\t\n\u000b\f\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(_SPACES))


def _groups(text: Column, pattern: str, wanted: list[int]) -> Column:
    """All wanted groups of a whole-line pattern from one regex pass.

    The match is rewritten as its groups joined by newlines, which no line can
    hold, then split; a line that does not match stays one element.
    """
    joined = "\n".join(f"${i}" for i in wanted)
    return F.split(F.regexp_replace(text, "(?d)" + pattern, joined), "\n")


MONTH_DAYS = [31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]


def rfc3164_timestamp(df: DataFrame, text: str, ref_year: int, out: str) -> DataFrame:
    """Add ``Mon d h:m:s`` of the given year as a UTC time.

    29 February rolls over to 1 March in a short year. Plain arithmetic over the
    split parts, each computed once in its own projection.
    """
    shape = r"^[A-Za-z]{3} +\d{1,2} +\d{1,2}:\d{2}:\d{2}$"
    months = ", ".join(f"'{m}'" for m in V.MONTHS)
    days = ", ".join(str(d) for d in MONTH_DAYS)
    df = df.withColumn("_t", F.when(F.col(text).rlike(shape), F.split(text, r"[ :]+")))
    df = df.withColumns(
        {
            "_mon": F.expr(f"cast(array_position(array({months}), lower(_t[0])) as int)"),
            "_day": F.expr("cast(_t[1] as int)"),
            "_secs": F.expr("cast(_t[2] as int) * 3600L + cast(_t[3] as int) * 60 + cast(_t[4] as int)"),
            "_ok": F.expr("_t[2] < '24' and _t[3] < '60' and _t[4] < '60' or length(_t[2]) = 1 and _t[3] < '60' and _t[4] < '60'"),
        }
    )
    good = F.expr(f"_ok and _mon > 0 and _day between 1 and element_at(array({days}), greatest(_mon, 1))")
    value = F.expr(
        f"timestamp_seconds((unix_date(make_date({int(ref_year)}, _mon, 1)) + _day - 1) * 86400L + _secs)"
    )
    return df.withColumn(out, F.when(good, value)).drop("_t", "_mon", "_day", "_secs", "_ok")


def rfc5424_timestamp(text: Column) -> Column:
    """ISO time with a literal ``Z``; any fraction length; offsets give null."""
    shape = r"^\d{4}-\d{2}-\d{2}T\d{1,2}:\d{2}:\d{2}([.,]\d+)?Z$"
    return F.when(text.rlike(shape), F.translate(text, ",", ".").try_cast("timestamp"))


def normalized_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def normalize_hostname(host: Column) -> Column:
    """First dot label, upper case, only A-Z 0-9 - _ kept."""
    # The two non-ASCII letters are the only ones whose upper case is in A-Z.
    kept = F.regexp_replace(F.substring_index(host, ".", 1), "[^A-Za-z0-9_\\-\u0131\u017f]", "")
    return F.upper(kept)


def severity_name(code: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in V.SEVERITY_NAMES]), code + 1)


def split_lines(df: DataFrame, line_col: str = "line") -> DataFrame:
    """Add ``original_message``, ``format`` and the raw ``_pri .. _message`` fields."""
    df = df.withColumn("original_message", trimmed(F.col(line_col)))
    text = F.col("original_message")
    # host, program, pid and message follow the time in both layouts
    df = df.withColumn("_p5", _groups(text, V.RFC5424_LINE, [1, 3, 4, 5, 6, 8]))
    df = df.withColumn(
        "_p3", F.when(F.size("_p5") == 1, _groups(text, V.RFC3164_LINE, [1, 2, 3, 4, 5, 6]))
    )
    df = df.withColumn(
        "_pf", F.when(F.size("_p3") == 1, _groups(text, V.PRIORITY_ONLY_LINE, [1, 2]))
    )
    is5 = F.size("_p5") > 1
    is3 = F.size("_p3") > 1
    isf = F.size("_pf") > 1
    df = df.withColumn(
        "format",
        F.when(F.length(line_col) == 0, "blank")
        .when(text == "", "invalid")
        .when(is5, "rfc5424")
        .when(is3, "rfc3164")
        .when(isf, "fallback")
        .otherwise("invalid"),
    )
    fmt = F.col("format")

    def pick(index5, fallback):
        return (
            F.when(fmt == "rfc5424", F.col("_p5")[index5])
            .when(fmt == "rfc3164", F.col("_p3")[index5])
            .when(fmt == "fallback", fallback)
        )

    return df.select(
        *[c for c in df.columns if c not in ("_p5", "_p3", "_pf")],
        pick(0, F.col("_pf")[0]).alias("_pri"),
        pick(1, F.lit("")).alias("_time"),
        pick(2, F.lit("unknown")).alias("_host"),
        pick(3, F.lit("unknown")).alias("program"),
        pick(4, F.lit("")).alias("_pid"),
        pick(5, F.col("_pf")[1]).alias("message"),
    )


def parse_lines(df: DataFrame, ref_year: int | None = None, line_col: str = "line") -> DataFrame:
    """Parse every line; rejects stay in the result with their ``format``."""
    if ref_year is None:
        ref_year = datetime.now(timezone.utc).year
    df = split_lines(df, line_col)
    fmt = F.col("format")
    parsed = fmt.isin("rfc5424", "rfc3164", "fallback")
    df = df.withColumn("_number", F.col("_pri").try_cast("bigint"))
    number = F.col("_number")
    df = df.withColumn(
        "priority",
        F.when(
            parsed,
            F.when(number.isNull(), 0)
            .when(number > V.MAX_PRIORITY, V.DEFAULT_PRIORITY)
            .otherwise(number)
            .cast("int"),
        ),
    )
    df = rfc3164_timestamp(df, "_time", ref_year, "_time3")
    df = df.withColumn(
        "timestamp",
        F.when(fmt == "rfc5424", rfc5424_timestamp(F.col("_time"))).when(fmt == "rfc3164", F.col("_time3")),
    )
    host = F.col("_host")
    no_host = host.isin("", "-")
    pid = F.when(F.col("_pid").rlike(r"^[+-]?\d+$"), F.col("_pid").try_cast("bigint"))
    df = df.withColumns(
        {
            "normalized_time": normalized_time(F.col("timestamp")),
            "facility": F.floor(F.col("priority") / 8).cast("int"),
            "severity": (F.col("priority") % 8).cast("int"),
            "hostname": F.when(no_host, host).otherwise(normalize_hostname(host)),
            "pid": F.when(parsed, F.coalesce(pid, F.lit(0).cast("bigint"))),
            "data_quality_issues": F.when(
                parsed,
                F.array_compact(
                    F.array(
                        F.when(fmt == "fallback", V.ISSUE_FORMAT),
                        F.when(number.isNull(), V.ISSUE_PRIORITY_PARSE).when(
                            number > V.MAX_PRIORITY, V.ISSUE_PRIORITY_RANGE
                        ),
                        F.when(F.col("timestamp").isNull(), V.ISSUE_TIMESTAMP),
                        F.when(no_host, V.ISSUE_HOSTNAME),
                    )
                ),
            ),
        }
    )
    name = F.when(number.isNotNull(), severity_name(F.col("severity")))
    return df.withColumn("severity_name", name).drop("_pri", "_time", "_time3", "_host", "_pid", "_number")


def origin(df: DataFrame) -> Column:
    """What tells the files of the lines apart: the whole path where the reader gave it, else the name."""
    return F.col("source_path" if "source_path" in df.columns else "source_file")


def record_id(*parts: Column | str) -> Column:
    """Deterministic 16-digit id from the file of a line (its :func:`origin`) and what it says; nulls are left out."""
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 16)


def is_parsed() -> Column:
    """Test on parsed rows. To drop rejects use :func:`parseable` before parsing instead."""
    return F.col("format").isin("rfc5424", "rfc3164", "fallback")


def parseable(line: Column) -> Column:
    """Will the line get one of the three layouts? The loosest one needs only its ``<digits>``.

    A filter on ``format`` would be pushed below the projections that compute it and
    run every pattern twice; this one is cheap and stays on the raw line.
    """
    return trimmed(line).rlike(r"^<\d+>")


def valid_ipv4(text: Column) -> Column:
    return text.rlike(V.IPV4_VALID)
