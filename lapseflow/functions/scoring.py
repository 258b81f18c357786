"""Column expressions for brandability, age, availability and sale stage."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Affixes that make a label brandable.
PREFIXES = (
    "anti", "de", "dis", "em", "en", "fore", "il", "im", "in", "inter", "ir", "mid", "mis",
    "non", "over", "pre", "re", "semi", "sub", "super", "trans", "un", "under",
)
SUFFIXES = (
    "able", "al", "ation", "ative", "ed", "en", "eous", "er", "es", "est", "ful", "ial", "ible",
    "ic", "ing", "ion", "ious", "ition", "itive", "ity", "ive", "less", "ly", "ment", "ness",
    "ous", "s", "tion", "y",
)
SHORT_LABEL = 6

# Days between a registrar's expiry date and general availability.
GRACE_DAYS = {"godaddy": 90, "sedo": 70}
# The feed whose domains can already be sold during their grace period.
GRACE_SELLER = "godaddy"


def brandable(label: Column, in_dictionary: Column) -> Column:
    """Short, a word, or built with a known affix. Affixes match case-sensitively."""
    starts = reduce(or_, (label.startswith(p) for p in PREFIXES))
    ends = reduce(or_, (label.endswith(s) for s in SUFFIXES))
    return (F.length(label) <= SHORT_LABEL) | in_dictionary | ends | starts


def grace_days(registrar: Column) -> Column:
    """Grace period by registrar; NULL for a registrar without a stated one."""
    days = F.lit(None).cast("int")
    for name, length in GRACE_DAYS.items():
        days = F.when(registrar == name, F.lit(length)).otherwise(days)
    return days


def available_on(expired: Column, registrar: Column) -> Column:
    return F.date_add(expired.cast("date"), grace_days(registrar))


def availability_text(expired: Column, registrar: Column) -> Column:
    """Month as a word, day as a number."""
    return F.date_format(available_on(expired, registrar), "MMMM/d")


def accredited(has_wiki: Column, alexa_score: Column) -> Column:
    return F.coalesce(has_wiki, F.lit(False)) | (F.coalesce(alexa_score, F.lit(0)) > 0)


def age_days(registered: Column, as_of: Column) -> Column:
    return F.datediff(as_of.cast("date"), registered.cast("date"))


def age_years(registered: Column, as_of: Column) -> Column:
    """Completed years: one less while this year's anniversary lies ahead."""

    def day_of_year(moment: Column) -> Column:
        return F.month(moment) * 100 + F.dayofmonth(moment)

    ahead = day_of_year(as_of) < day_of_year(registered)
    return F.year(as_of) - F.year(registered) - ahead.cast("int")


def sale_stage(expired: Column, registrar: Column, as_of: Column) -> Column:
    """Where a listing stands between being listed and being free to buy.

    Past expiry plus grace it is sellable; inside the grace period one feed
    sells already ("grace"), the other makes the buyer wait ("waiting"). A registrar
    without a grace period sells from expiry on.
    """
    free = expired + F.make_dt_interval(days=F.coalesce(grace_days(registrar), F.lit(0))) <= as_of
    return (
        F.when(free, F.lit("sellable"))
        .when((expired <= as_of) & (registrar == GRACE_SELLER), F.lit("grace"))
        .when(expired <= as_of, F.lit("waiting"))
        .otherwise(F.lit("listed"))
    )
