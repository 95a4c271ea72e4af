"""Years and life dates as Column expressions.  Years are signed integers; BC is negative."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LIFESPAN = 120
MAX_SPAN = 200


#: The labels of the date rules.
FIX_LABELS = (
    "sign_error_death", "sign_error_birth", "wrong_person_death", "wrong_person_birth", "sign_error_both", "wrong_person_both_neg",
    "wrong_person_both", "implausible_lifespan",
)


def date_case(b: Column, d: Column) -> Column:
    """Which date rule applies: one of :data:`FIX_LABELS`, null where the dates stay as they are."""
    ab, ad = F.abs(b), F.abs(d)
    within = lambda x: (x > 0) & (x < MAX_LIFESPAN)
    mixed, both_bc = (b < 0) & (d > 0), (b < 0) & (d < 0) & (d < b)
    return (
        F.when(b.isNull() | d.isNull(), None)
        .when((b > 0) & (d < 0), F.when(within(ad - b), "sign_error_death").otherwise("wrong_person_death"))
        .when(mixed & within(d - ab), "sign_error_birth")
        .when(mixed & ~within(ab + d), "wrong_person_birth")
        .when(both_bc, F.when(within(ad - ab), "sign_error_both").otherwise("wrong_person_both_neg"))
        .when((b > 0) & (d > 0) & (b > d), "wrong_person_both")
        .when((b > 0) & (d > 0) & (d - b > MAX_SPAN), "implausible_lifespan")
    )


def checked_dates(b: Column, d: Column) -> Column:
    """``struct<birth_year, death_year, label>`` after the sanity rules; first rule wins."""
    # The label is made once, in the array's only element, and read from there.
    one = F.array(F.struct(b.cast("int").alias("b"), d.cast("int").alias("d"), date_case(b, d).alias("label")))

    def fixed(x: Column) -> Column:
        is_ = x["label"].isin
        birth = F.when(is_("wrong_person_birth", "wrong_person_both_neg", "wrong_person_both", "implausible_lifespan"), None).when(is_("sign_error_birth", "sign_error_both"), F.abs(x["b"])).otherwise(x["b"])
        death = F.when(is_("wrong_person_death", "wrong_person_both_neg", "wrong_person_both", "implausible_lifespan"), None).when(is_("sign_error_death", "sign_error_both"), F.abs(x["d"])).otherwise(x["d"])
        return F.struct(birth.alias("birth_year"), death.alias("death_year"), x["label"].alias("label"))

    return F.get(F.transform(one, fixed), 0)


def validate_dates(b: Column, d: Column) -> Column:
    """``struct<birth_year, death_year>`` after the sanity rules."""
    return checked_dates(b, d).dropFields("label")


def suspicious_dates(b: Column, d: Column) -> Column:
    """Dates that stay doubtful after the rules: BC order, or a span of over 200 years."""
    return F.coalesce(((b < 0) & (d < 0) & (d < b)) | (d - b > MAX_SPAN), F.lit(False))


def parse_year(c: Column) -> Column:
    """Year of mixed text: BC gives minus all digits; four digits lose their sign; else a signed number."""
    s = c.cast("string")
    digits = F.regexp_replace(s, r"[^0-9]", "")
    four = F.regexp_extract(s, r"^-?([0-9]{4})", 1)
    number = F.regexp_extract(s, r"^(-?[0-9]+)", 1)
    return (
        F.when(s.contains("BC") & (digits != ""), -digits.try_cast("int"))
        .when(s.contains("BC"), None)
        .when(four != "", four.try_cast("int"))
        .when(number != "", number.try_cast("int"))
    )


def get_year(c: Column) -> Column:
    """As :func:`parse_year`; 0 and empty text are no year, fractions are cut off."""
    text = F.nullif(c.cast("string"), F.lit(""))
    number = F.when(text.rlike(r"^-?[0-9]+\.[0-9]+$"), F.regexp_extract(text, r"^(-?[0-9]+)", 1)).otherwise(text)
    return F.nullif(parse_year(number), F.lit(0))


def viewer_year(c: Column) -> Column:
    """Year of a number, of a BC text or of an ISO date; null for any other text."""
    s = c.cast("string")
    bc = F.nullif(F.regexp_replace(s, r"[^0-9]", ""), F.lit(""))
    iso = F.nullif(F.regexp_extract(s, r"^(-?[0-9]+)(?:-[0-9]{2}(?:-[0-9]{2}(?:T.*)?)?)?$", 1), F.lit(""))
    return F.when(s.contains("BC"), -bc.try_cast("int")).otherwise(iso.try_cast("int"))


def parse_to_integer(c: Column) -> Column:
    """Strict twin that keeps the sign and leaves what it cannot read as text."""
    s = F.trim(c.cast("string"))
    bc = F.regexp_extract(s, r"^([0-9]+) *BCE?$", 1)
    ad = F.regexp_extract(s, r"^([0-9]+) *(?:AD|CE)$", 1)
    iso = F.regexp_extract(s, r"^(-?[0-9]{1,4})-[0-9]{2}-[0-9]{2}", 1)
    num = F.regexp_extract(s, r"^(-?[0-9]+)$", 1)
    return (
        F.when(bc != "", (-bc.try_cast("int")).cast("string"))
        .when(ad != "", ad.try_cast("int").cast("string"))
        .when(iso != "", iso.try_cast("int").cast("string"))
        .when(num != "", num.try_cast("int").cast("string"))
        .otherwise(c.cast("string"))
    )


def drop_time(c: Column) -> Column:
    """The part of a timestamp text before the ``T``."""
    return F.split_part(c, F.lit("T"), F.lit(1))


def is_bad_date(c: Column) -> Column:
    """Text that is neither a number, an ISO date nor a BC year."""
    return c.isNotNull() & ~c.rlike(r"^-?[0-9]{1,4}$|^[0-9]{4}-[0-9]{2}-[0-9]{2}$|^[0-9]+ BC$")


def epoch_year(ms: Column) -> Column:
    """Year of epoch milliseconds; before year 1, and beyond the calendar, by mean year length."""
    sec = F.floor(ms / 1000)
    mean = 1970 + F.when(sec < 0, F.ceil(sec / 31556926)).otherwise(F.floor(sec / 31556926))
    return mean.cast("int")


def book_year(original: Column, published: Column) -> Column:
    """The original year (0 counts), else the publication year if it is not 0."""
    return F.coalesce(original, F.nullif(published, F.lit(0)))


def year_in_text(c: Column) -> Column:
    """The first four digits of a text."""
    return F.nullif(F.regexp_extract(c, r"([0-9]{4})", 1), F.lit("")).cast("int")


def person_year_in_text(c: Column) -> Column:
    """The first three or four digits, negative where BC or BCE follows."""
    y = F.nullif(F.regexp_extract(c, r"([0-9]{3,4})", 1), F.lit("")).cast("int")
    return F.when(c.rlike(r"[0-9]{3,4} *BCE?"), -y).otherwise(y)


def answered_year(c: Column) -> Column:
    """The first three or four digits of an answer, a sign before them included."""
    return F.nullif(F.regexp_extract(c, r"(-?[0-9]{3,4})", 1), F.lit("")).cast("int")


#: Years that a flipped sign explains.
FLIPPED = (-2025, -1000)


def flip_sign(b: Column, d: Column) -> Column:
    """``struct<birth_year, death_year>``: both made positive where the birth is in :data:`FLIPPED`."""
    hit = b.between(*FLIPPED)
    return F.struct(F.when(hit, F.abs(b)).otherwise(b).cast("int").alias("birth_year"), F.when(hit, F.abs(d)).otherwise(d).cast("int").alias("death_year"))


#: Upper bounds and names of the epochs.
EPOCHS = (
    (500, "Ancient"), (1000, "Early Medieval"), (1300, "High Medieval"), (1500, "Late Medieval"), (1600, "Renaissance"),
    (1800, "Enlightenment"), (1870, "Romantic"), (1945, "Modern"),
)


def epoch_of(year: Column) -> Column:
    """Epoch of a birth year; null stays null."""
    out = F.lit("Contemporary")
    for bound, name in reversed(EPOCHS):
        out = F.when(year < bound, name).otherwise(out)
    return F.when(year.isNotNull(), out)


def timeline_x(year: Column) -> Column:
    """Pixels from the year 0: 0.3 a year before 1800, 8 after."""
    return F.when(year < 1800, year * 0.3).otherwise(1800 * 0.3 + (year - 1800) * 8.0)
