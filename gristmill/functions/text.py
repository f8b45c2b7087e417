"""Column expressions over text. All run in the JVM, row by row, without a shuffle."""

from pyspark.sql import Column, functions as F

# The white-space characters that a Unicode-aware strip removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0 "
    "           "
    "    　"
)

# Whole texts that carry no opinion (any case).
BOILERPLATE_TERMS = (
    "No Negative",
    "No Positive",
    "nothing",
    "nothing really",
    "none",
    "n a",
    "na",
    "everything",
    "location",
    "the location",
    "breakfast",
    "the breakfast",
    "staff",
)

# A token is a run of letters and digits.
TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def strip(text: Column) -> Column:
    """Remove white space of any script from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_boilerplate(text: Column, terms=BOILERPLATE_TERMS) -> Column:
    """True where the whole value matches one of ``terms`` (regular expressions), any case.

    No terms means no filter. ``\\A`` and ``\\z`` are used because ``$`` would also
    match before a trailing line break.
    """
    if not terms:
        return F.lit(False)
    return text.rlike(r"(?iu)\A(?:" + "|".join(terms) + r")\z")


def tokens(text: Column) -> Column:
    """Lower-case tokens in text order."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda t: t != "")


def token_counts(text: Column) -> Column:
    """Each token of a text once, with its count: an array of (token, n)."""
    def runs(found):
        heads = F.filter(F.sequence(F.lit(1), F.size(found)), lambda i: (i == 1) | (F.get(found, i - 1) != F.get(found, i - 2)))
        return F.transform(F.array(heads), lambda heads: F.transform(heads, lambda head, place: F.struct(
            F.get(found, head - 1).alias("token"),
            (F.coalesce(F.get(heads, place + 1), F.size(found) + 1) - head).cast("long").alias("n"))))[0]

    # A lambda's argument is computed once, however often it is read.
    return F.flatten(F.transform(F.filter(F.array(F.sort_array(tokens(text))), lambda found: F.size(found) > 0), runs))


def cut(items: Column, max_items: int) -> Column:
    """The first ``max_items`` elements of an array."""
    return F.slice(items, 1, max_items)


def without_ends(items: Column) -> Column:
    """An array without its first and last element; empty when it has fewer than two."""
    return F.when(F.size(items) > 2, F.slice(items, F.lit(2), F.size(items) - 2)) \
        .otherwise(F.slice(items, 1, 0))


def label_name(label: Column) -> Column:
    return F.when(label == 1, "POSITIVE").otherwise("NEGATIVE")
