"""Name cleaning as column expressions."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define the three text functions. ``(?U)`` makes Java's \w, \s,
# \b and \d follow Unicode; [^\n]* stands for "to the end of the line".
BRACKETS = r"[\(\[][^\)\]]*[\)\]]"
FEATURING = r"(?U)\b(feat\.?|ft\.?|featuring)\b[^\n]*"
VERSIONS = r"(?U)\b(live|remix|extended|radio edit|acoustic|remastered(?:\s+\d{4})?)\b"
COVERS = r"(?U)\bcover(ed)?\b[^\n]*"
PUNCTUATION = r"(?U)[^\w\s]"
SPACES = r"(?U)\s+"
MARKS = r"\p{M}"

_NON_ASCII = r"[^\x00-\x7F]"


def _column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nfkd(col: str | Column) -> Column:
    """Unicode compatibility decomposition.

    Spark has no such function, so this is the one Python step of the text path. ASCII text is its
    own decomposition and goes to Python as null, so only texts with other letters are shipped. They stay
    Arrow strings there: as Python objects a batch of long texts takes several times its size.
    """

    @F.arrow_udf("string")
    def decompose(texts: pa.Array) -> pa.Array:
        return pc.utf8_normalize(texts, "NFKD")

    text = _column(col)
    return F.coalesce(decompose(F.when(text.rlike(_NON_ASCII), text)), text)


def strip_marks(col: str | Column) -> Column:
    return F.regexp_replace(nfkd(col), MARKS, "")


def _tidy(text: Column) -> Column:
    text = F.regexp_replace(text, PUNCTUATION, " ")
    return F.trim(F.regexp_replace(text, SPACES, " "))


def standardize_text(col: str | Column) -> Column:
    """Lower-case words without accents or punctuation, one space apart; null becomes ''."""
    text = F.coalesce(_column(col).cast("string"), F.lit(""))
    return _tidy(F.lower(strip_marks(text)))


def title_case(col: str | Column) -> Column:
    """Capital after every character that is neither letter nor digit.

    ``initcap`` starts words at spaces only, so a marked space is put behind the other word ends
    and taken out again afterwards. It also turns a first sharp s into "Ss" where full upper case
    is "SS", so texts with letters beyond ASCII go word by word.
    """
    marked = F.regexp_replace(_column(col), r"([^\p{IsAlphabetic}\p{N} ])", "$1\u0001 ")

    def capital(word: Column) -> Column:
        rest = F.substring(word, F.lit(2), F.char_length(word))
        return F.concat(F.upper(F.substring(word, 1, 1)), rest)

    def by_word(text: Column) -> Column:
        return F.array_join(F.transform(F.split(F.lower(text), " "), capital), " ")

    # a one-element transform binds the text, which is otherwise computed for each mention of it
    titled = F.transform(
        F.array(marked),
        lambda text: F.when(text.rlike(_NON_ASCII), by_word(text)).otherwise(F.initcap(text)),
    )
    return F.regexp_replace(titled[0], "\u0001 ", "")


def _without_versions(text: Column) -> Column:
    for pattern in (BRACKETS, FEATURING, VERSIONS):
        text = F.regexp_replace(text, pattern, " ")
    return text


def clean_name(col: str | Column) -> Column:
    """Display name: no brackets, guests or version words, in title case."""
    return title_case(_tidy(_without_versions(F.coalesce(_column(col), F.lit("")))))


def normalize_title(col: str | Column) -> Column:
    """Grouping key of a title: like ``clean_name`` but lower case and without 'cover...'."""
    text = _without_versions(F.lower(F.coalesce(_column(col), F.lit(""))))
    return _tidy(F.regexp_replace(text, COVERS, " "))
