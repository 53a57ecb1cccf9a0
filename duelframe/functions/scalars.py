"""Column expressions. All run inside whole-stage codegen; none needs Python workers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from duelframe.schema import CLASSES, ELO

# Rewriting steps from the accepted date layouts to year/month/day. A second number above 12 can
# only be a day; two-digit years 69..99 belong to the last century.
DATE_STEPS = (
    (r"^(\d{1,2})/(1[3-9]|2\d|3[01])/(\d{2}|\d{4})$", "$2/$1/$3"),
    (r"^(\d{1,2}/\d{1,2})/(69|[7-9]\d)$", "$1/19$2"),
    (r"^(\d{1,2}/\d{1,2})/(\d{2})$", "$1/20$2"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3/$2/$1"),
)

# English month names, and what may stand around the tokens of a date: a time of day and its offset at
# the end, a weekday in front, ordinal endings, full stops behind names, and missing blanks around names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
DATE_NOISE = (
    (r"[t ]+(\d{1,2}:\d{2}(:\d{2}([.,]\d+)?)?\s*([ap]m)?|\d{1,2}\s*[ap]m)\s*(z|utc|gmt|[+-]\d{2}:?\d{2})?$", ""),
    (r"^(mon|tue|wed|thu|fri|sat|sun)[a-z]*[,. ]+", ""),
    (r"(\d)(st|nd|rd|th)\b", "$1"),
    (r"(?<=\d)(?=[a-z])|(?<=[a-z])(?=\d)", " "),
    (r"(?<=[a-z])\.", ""),
)
# One to three tokens, of which at most one is a name.
DATE_TOKENS = r"^(?!.*[a-z][^a-z]+[a-z])(\d{1,4}|[a-z]{3,9})([ /.,-]+(\d{1,4}|[a-z]{3,9})){1,2}$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map_of(values: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


# --- text and dates ---------------------------------------------------------------------------------


def parse_date(c: Column | str) -> Column:
    """Date from text, day first; month first where the second number cannot be a month; else NULL.

    The common layouts, day/month/year with two or four year digits and year-month-day with a slash, dash or dot, are
    put together as an ISO date and read once. All other text is read by ``generic_date``.
    """
    text = F.trim(col(c))
    flat = F.translate(text, "-.", "//")
    for pattern, layout in DATE_STEPS:
        flat = F.regexp_replace(flat, pattern, layout)
    iso = F.translate(F.regexp_extract(flat, r"^\d{4}/\d{1,2}/\d{1,2}$", 0), "/", "-").try_cast("date")
    return F.coalesce(iso, generic_date(text))


def generic_date(c: Column | str) -> Column:
    """Date from free text by its tokens: numbers, a month name, and what may stand around them.

    A time of day with an offset at the end, a weekday in front, ordinal endings and full stops fall away. What is left
    must be one to three tokens between spaces or ``/ . , -``:

    * eight digits: year, month, day;
    * three numbers: a first one of four digits is the year, then month and day; else day, month, year; day and month
      change places where only that makes a month;
    * a month name, cut at three letters or more, with two numbers: a number of four digits is the year, else the
      first is the day; with one number of four digits: the first of that month.

    Years of two digits from 69 on belong to the last century. Anything else, and days that do not exist, are NULL.
    """
    day = F.lower(F.trim(col(c)))
    for pattern, kept in DATE_NOISE:
        day = F.regexp_replace(day, pattern, kept)
    # The cleaned text stands in an array of one, so that the many uses below read it once.
    return F.get(F.transform(F.array(day), _date_of_tokens), F.lit(0)).try_cast("date")


def _date_of_tokens(day: Column) -> Column:
    word = F.regexp_extract(day, r"[a-z]+", 0)
    numbers = F.regexp_extract_all(day, F.lit(r"\d+"), F.lit(0))
    named = F.array_position(F.transform(F.array(*map(F.lit, MONTHS)), lambda m: F.startswith(m, word)), True)
    first, second, third = (F.get(numbers, F.lit(i)) for i in range(3))

    def iso(year: Column, month: Column, date: Column) -> Column:
        short = F.when(year.cast("int") >= 69, F.concat(F.lit("19"), year)).otherwise(F.concat(F.lit("20"), F.lpad(year, 2, "0")))
        full = F.when(F.length(year) == 4, year).when(F.length(year) <= 2, short)
        return F.concat_ws("-", full, F.lpad(month.cast("string"), 2, "0"), F.lpad(date.cast("string"), 2, "0"))

    def either(year: Column, month: Column, date: Column) -> Column:
        swap = (month.cast("int") > 12) & (date.cast("int") <= 12)
        return iso(year, F.when(swap, date).otherwise(month), F.when(swap, month).otherwise(date))

    count, four = F.size(numbers), F.length(first) == 4
    plain = F.when(four, either(first, second, third)).otherwise(either(third, second, first))
    with_name = F.when(four, iso(first, named, second)).otherwise(iso(second, named, first))
    return (
        F.when(day.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2)))
        .when(~day.rlike(DATE_TOKENS), None)
        .when((word == "") & (count == 3), plain)
        .when((word != "") & (named > 0) & (count == 2), with_name)
        .when((word != "") & (named > 0) & (count == 1) & four, iso(first, named, F.lit("01")))
    )


def kickoff_timestamp(day: Column | str, time: Column | str) -> Column:
    """Date plus kickoff time; a missing time is midnight, an unreadable one falls back to the date."""
    day = col(day)
    text = F.concat_ws(" ", day.cast("string"), F.coalesce(F.trim(col(time)), F.lit("00:00")))
    return F.coalesce(text.try_cast("timestamp_ntz"), day.cast("timestamp_ntz"))


def normalise_name(c: Column | str, aliases: Mapping[str, str]) -> Column:
    """Trim, then apply the alias map; unknown names pass through, NULL stays NULL."""
    clean = F.trim(col(c))
    if not aliases:
        return clean
    return F.coalesce(F.try_element_at(_map_of(aliases), clean), clean)


def to_number(c: Column | str) -> Column:
    """Number from text; anything unreadable, NaN included, gives NULL."""
    number = col(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def iso_day(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def iso_week_label(c: Column | str) -> Column:
    """``W<ISO week>-<calendar year>``; the year is deliberately not the ISO year."""
    return F.concat(F.lit("W"), F.weekofyear(col(c)), F.lit("-"), F.year(col(c)))


def season_start_year(c: Column | str) -> Column:
    return F.split(col(c), "-")[0].try_cast("int")


def season_code(c: Column | str) -> Column:
    """``2023-24`` becomes ``2324``."""
    parts = F.split(col(c), "-")
    return F.concat(F.right(parts[0], F.lit(2)), parts[1])


def season_path(c: Column | str, template: str = "{code}/E0.csv") -> Column:
    head, tail = template.split("{code}")
    return F.concat(F.lit(head), season_code(c), F.lit(tail))


def season_from_path(c: Column | str) -> Column:
    """Season label found in a file name; NULL when there is none."""
    label = F.regexp_extract(F.element_at(F.split(col(c), "/"), -1), r"(\d{4}-\d{2})", 1)
    return F.when(label != "", label)


def natural_key(season, day, home, away) -> Column:
    return F.concat_ws(":", col(season), iso_day(day), col(home).cast("string"), col(away).cast("string"))


def short_code(name: Column | str) -> Column:
    return F.upper(F.substring(col(name), 1, 3))


def colour(name: Column | str, colours: Mapping[str, str], default: str = "#8891B8") -> Column:
    if not colours:
        return F.lit(default)
    return F.coalesce(F.try_element_at(_map_of(colours), col(name)), F.lit(default))


def matches_search(name: Column | str, query: str) -> Column:
    """Case-insensitive substring test; a blank query accepts everything."""
    needle = query.strip().lower()
    return F.lower(col(name)).contains(needle) if needle else F.lit(True)


# --- results and labels -----------------------------------------------------------------------------


def result_from_score(home: Column | str, away: Column | str) -> Column:
    home, away = col(home), col(away)
    return F.when(home > away, "H").when(away > home, "A").when(home == away, "D")


def validated_result(given: Column | str, home: Column | str, away: Column | str) -> Column:
    """The given result when it is H, D or A, otherwise the one the score implies."""
    given = col(given)
    return F.when(given.isin(*CLASSES), given).otherwise(result_from_score(home, away))


def points(result: Column | str, is_home: Column, strict: bool = False) -> Column:
    result = col(result)
    out = (
        F.when(result == "D", 1)
        .when(result == "H", F.when(is_home, 3).otherwise(0))
        .when(result == "A", F.when(is_home, 0).otherwise(3))
    )
    if strict:
        out = out.otherwise(F.raise_error(F.concat(F.lit("unexpected result label: "), F.coalesce(result, F.lit("NULL")))).cast("int"))
    return out


def class_index(result: Column | str) -> Column:
    """H, D, A as 0, 1, 2."""
    result = col(result)
    return reduce(lambda acc, kv: acc.when(result == kv[1], kv[0]), list(enumerate(CLASSES))[1:], F.when(result == "H", 0))


def descending_target(result: Column | str) -> Column:
    """H=2, D=1, everything else 0."""
    return F.when(col(result) == "H", 2).when(col(result) == "D", 1).otherwise(0)


def home_win_target(result: Column | str) -> Column:
    return F.when(col(result) == "H", 1).otherwise(0)


def shot_accuracy(on_target: Column | str, shots: Column | str) -> Column:
    return col(on_target) / (col(shots) + 1)


# --- numbers and probabilities ----------------------------------------------------------------------


def finite(c: Column | str) -> Column:
    """NaN and infinities become NULL."""
    c = col(c)
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def implied_probabilities(home, draw, away) -> tuple[Column, Column, Column]:
    """Prices to probabilities that add to one; NULL unless all three prices are above 1.0."""
    prices = [col(home), col(draw), col(away)]
    usable = reduce(lambda a, b: a & b, [p.isNotNull() & ~F.isnan(p) & (p > 1.0) for p in prices])
    inverse = [F.lit(1.0) / p for p in prices]
    total = inverse[0] + inverse[1] + inverse[2]
    return tuple(F.when(usable, i / total) for i in inverse)


def sanitise_triple(home, draw, away) -> tuple[Column, Column, Column]:
    """Clip to [0, 1] and renormalise; one third each when that is impossible."""
    raw = [col(home).cast("double"), col(draw).cast("double"), col(away).cast("double")]
    broken = reduce(lambda a, b: a | b, [c.isNull() | F.isnan(c) for c in raw])
    clipped = [F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)) for c in raw]
    total = clipped[0] + clipped[1] + clipped[2]
    return tuple(F.when(broken | (total <= 0), F.lit(1.0 / 3.0)).otherwise(c / total) for c in clipped)


def elo_expected(home, away, home_advantage: float = ELO["home_advantage"]) -> Column:
    gap = col(away) - (col(home) + F.lit(float(home_advantage)))
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), gap / F.lit(400.0)))


def actual_home_score(result: Column | str) -> Column:
    return F.when(col(result) == "H", 1.0).when(col(result) == "D", 0.5).otherwise(0.0)


def predicted_label(home, draw, away) -> Column:
    """Largest probability wins; ties go to the earlier of H, D, A."""
    h, d, a = col(home), col(draw), col(away)
    return F.when((h >= d) & (h >= a), "H").when(d >= a, "D").otherwise("A")


def outcome_badge(home, draw, away) -> Column:
    """Display outcome: home if no smaller than both, away if larger than both, else draw."""
    h, d, a = col(home), col(draw), col(away)
    return F.when((h >= a) & (h >= d), "home").when((a > h) & (a > d), "away").otherwise("draw")


def integer_percentages(home, draw, away) -> tuple[Column, Column, Column]:
    """Whole percentages that add to 100; the away side takes the remainder.

    A negative remainder is taken off the larger of home and draw and the away side becomes 0. ``away`` is
    accepted for symmetry: its value follows from the other two.
    """
    h = F.floor(col(home) * 100 + F.lit(0.5))
    d = F.floor(col(draw) * 100 + F.lit(0.5))
    rest = F.lit(100) - h - d
    over = rest < 0
    return (
        F.when(over & (h >= d), F.greatest(F.lit(0), h + rest)).otherwise(h),
        F.when(over & (h < d), F.greatest(F.lit(0), d + rest)).otherwise(d),
        F.when(over, F.lit(0)).otherwise(rest),
    )


def _or_default(c: Column | str, default: float) -> Column:
    # A zero counts as missing here, like an absent value.
    c = col(c)
    return F.when(c.isNull() | F.isnan(c) | (c == 0), F.lit(default)).otherwise(c)


def expected_goals(p_home, p_draw, p_away, prefix: str = "") -> tuple[Column, Column]:
    """Heuristic goal estimate of both sides from form, rating gap, rest gap and probabilities.

    Reads ``home_goals_for_5``, ``away_goals_for_5``, ``home_goals_against_5``, ``away_goals_against_5``,
    ``elo_diff`` and ``rest_days_diff`` (optionally prefixed, e.g. ``"f."``).
    """
    # Fallback rate 1.35, weights 0.35 / 0.0004 / 0.02 / 0.15, rest clamp 5, range 0..6.
    rate = 1.35
    home_for = _or_default(f"{prefix}home_goals_for_5", rate)
    away_for = _or_default(f"{prefix}away_goals_for_5", rate)
    home_against = _or_default(f"{prefix}home_goals_against_5", rate)
    away_against = _or_default(f"{prefix}away_goals_against_5", rate)
    gap = _or_default(f"{prefix}elo_diff", 0.0)
    rest = F.greatest(F.least(_or_default(f"{prefix}rest_days_diff", 0.0), F.lit(5.0)), F.lit(-5.0))
    h, d, a = col(p_home), col(p_draw), col(p_away)
    tilt = 0.35 * (h - a) + 0.0004 * gap + 0.02 * rest
    pull = 0.15 * d
    home = (home_for + away_against) / 2.0 + tilt + pull
    away = (away_for + home_against) / 2.0 - tilt + pull
    # Scaled and floored: a decimal rounding would depend on how an engine reads doubles half way between digits.
    return tuple(F.floor(F.least(F.greatest(x, F.lit(0.0)), F.lit(6.0)) * 10000.0 + 0.5) / 10000.0 for x in (home, away))


def json_snapshot(columns: Sequence[str], date_columns: Sequence[str] = (), double_columns: Sequence[str] = ()) -> Column:
    """JSON object of the named columns: dates as ISO timestamps, NaN as null, nulls kept."""
    def safe(name: str) -> Column:
        if name in date_columns:
            return F.date_format(F.col(name), "yyyy-MM-dd'T'HH:mm:ss").alias(name)
        if name in double_columns:
            return F.when(~F.isnan(F.col(name)), F.col(name)).alias(name)
        return F.col(name)

    return F.to_json(F.struct(*[safe(c) for c in columns]), {"ignoreNullFields": "false"})


def log_line(ts: Column, event: Column | str, fields: Mapping[str, tuple[Column, bool]]) -> Column:
    """``ts=… | event=… | k=v`` with sorted keys; a field flagged as float prints six decimals."""
    parts = [F.concat(F.lit("ts="), ts), F.concat(F.lit("event="), col(event))]
    for key in sorted(fields):
        value, is_float = fields[key]
        text = F.format_string("%.6f", value) if is_float else value.cast("string")
        parts.append(F.concat(F.lit(f"{key}="), text))
    return F.concat_ws(" | ", *parts)
