"""Text expressions: cleaning, title signals, tag lists, ids and genre rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, prefixes, keywords and fallbacks the results depend on.
URL_PATTERN = r"(?:http|www)[^\s\p{Z}]+"
NOT_WORD_PATTERN = r"[^\p{L}\p{N}_\s]"
SPACE_PATTERN = r"\s+"
UPPERCASE_CLASS = r"\p{IsUppercase}"
DIGIT_PATTERN = r"\p{Nd}"
VIDEO_LINK_PREFIX = "https://www.youtube.com/watch?v="
VIDEO_ID_PATTERNS = (
    r"(?:v=|\/)([0-9A-Za-z_-]{11}).*",
    r"(?:youtu\.be\/)([0-9A-Za-z_-]{11})",
    r"(?:embed\/)([0-9A-Za-z_-]{11})",
)
GENRE_KEYWORDS = (("minecraft", "Gaming"), ("music", "Music"), ("tech", "Tech"), ("education", "Education"))
DEFAULT_GENRE = "Vlog"
WHITESPACE = " \t\n\r\x0b\x0c"


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Trim all ASCII whitespace, not only blanks."""
    return F.trim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    """Lower case, no links, punctuation to blanks, single blanks, trimmed; null becomes empty."""
    without_links = F.regexp_replace(F.lower(_or_empty(c)), URL_PATTERN, "")
    words_only = F.regexp_replace(without_links, NOT_WORD_PATTERN, " ")
    return F.trim(F.regexp_replace(words_only, SPACE_PATTERN, " "))


def corpus(cols: Sequence[str]) -> Column:
    """The given text columns joined by blanks, then cleaned."""
    return clean_text(F.concat_ws(" ", *[_or_empty(F.col(c)) for c in cols]))


def joined_lower(title: Column, tags: Column) -> Column:
    """Title and a tag array in one lower-case string, with no other cleaning."""
    return strip(F.lower(F.concat(_or_empty(title), F.lit(" "), _or_empty(F.array_join(tags, " ")))))


def title_features(title: Column, uppercase: str = UPPERCASE_CLASS) -> dict[str, Column]:
    """Title signals by name; lengths count code points."""
    t = _or_empty(title)
    size = F.length(t)
    caps = F.length(F.regexp_replace(t, f"[^{uppercase}]+", ""))
    return {
        "title_len": size,
        "caps_count": caps,
        "caps_ratio": caps / (size + 1),
        "exclamation_count": size - F.length(F.replace(t, F.lit("!"), F.lit(""))),
        "question_count": size - F.length(F.replace(t, F.lit("?"), F.lit(""))),
        "has_digits": t.rlike(DIGIT_PATTERN).cast("int"),
    }


def tag_list(c: Column) -> Column:
    """Comma-joined tags as a lower-case array; order and repeats are kept, null gives no tags."""
    parts = F.transform(F.split(_or_empty(c), ","), lambda t: F.lower(strip(t)))
    return F.filter(parts, lambda t: t != "")


def joined_tags(c: Column) -> Column:
    """A tag array as the stored comma-joined string; null becomes empty."""
    return _or_empty(F.array_join(c, ","))


def video_link(video_id: Column) -> Column:
    return F.concat(F.lit(VIDEO_LINK_PREFIX), video_id)


def video_id_of(url: Column) -> Column:
    """The 11-character id of a link, the input itself if it already is one, else null."""
    found = [F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in VIDEO_ID_PATTERNS]
    return F.when((F.length(url) == 11) & ~F.contains(url, F.lit(" ")), url).otherwise(F.coalesce(*found))


def gaming_or_default(tags: Column) -> Column:
    """The training rule: one keyword decides."""
    keyword, genre = GENRE_KEYWORDS[0]
    return F.when(F.contains(F.lower(_or_empty(tags)), F.lit(keyword)), genre).otherwise(DEFAULT_GENRE)


def keyword_genre(tags: Column) -> Column:
    """The evaluation rule: the first keyword that occurs wins."""
    lowered = F.lower(_or_empty(tags))
    return F.coalesce(
        *[F.when(F.contains(lowered, F.lit(k)), F.lit(genre)) for k, genre in GENRE_KEYWORDS], F.lit(DEFAULT_GENRE)
    )


def truthy(c: Column) -> Column:
    """Booleans given as text; anything else, null included, is false."""
    return F.coalesce(F.lower(c.cast("string")).isin("true", "1", "yes"), F.lit(False))
