"""Text cleaning as Column expressions; nothing here leaves the JVM.

Character classes are spelled out as ``\\p{L}\\p{N}_`` and an explicit white-space
set, so that words and blanks mean the same for every script and every engine.
Quantifiers that a later atom cannot overlap are possessive: the patterns run in
one pass and never recurse, whatever the length of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.functions import lexicon

WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"

# A mail address may start where a run of local-part characters starts, or right after a match.
EMAIL = rf"(?:\G|(?<![{WORD}.+-]))[{WORD}.+-]++@[{WORD}-]++(?:\.[{WORD}-]++)++"
HANDLE = rf"(?:^|[^@{WORD}])@[{WORD}]{{1,15}}+(?![{WORD}])"
HASHTAG = rf"#[{WORD}]++"
URL = rf"https?://[^{SPACE}]++|www\.[^{SPACE}]++"
MARKUP = r"<(?:\"[^\"]*+\"|'[^']*+'|[^'\">]++)*+>"
PUNCTUATION = rf"[^{WORD}{SPACE}]"


def _ascii(holds: Callable[[str], bool]) -> str:
    """A class of the ASCII characters that hold, one by one: Java then looks them up in a table."""
    return "[" + "".join(rf"\x{i:02x}" for i in range(128) if holds(chr(i))) + "]"


# The same patterns for texts of ASCII alone, where classes of all scripts cost several times more.
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
ASCII_BLANK = _ascii(lambda c: c in _BLANKS)
# A space by itself stays as it is.
ASCII_BLANKS = rf"{ASCII_BLANK}(?:{ASCII_BLANK}++|(?<! ))"
ASCII_PUNCTUATION = _ascii(lambda c: not (c.isalnum() or c == "_" or c in _BLANKS))
ASCII_HANDLE = rf"(?:^|{_ascii(lambda c: not (c.isalnum() or c in '_@'))})@{_ascii(lambda c: c.isalnum() or c == '_')}{{1,15}}+(?!{_ascii(lambda c: c.isalnum() or c == '_')})"

# A mapping up to this size may be inlined into the plan as a literal.
MAX_INLINE_ENTRIES = 5_000


def lower_case(text: Column) -> Column:
    return F.lower(text)


def is_retweet(text: Column) -> Column:
    return text.startswith("RT")


def mask_email(text: Column) -> Column:
    # An address holds no space, so only tokens with an @ are searched.
    def mask(token: Column) -> Column:
        masked = F.regexp_replace(token, EMAIL, lexicon.EMAIL_MARK)
        return F.when(token.contains("@"), masked).otherwise(token)

    return F.array_join(F.transform(F.split(text, " "), mask), " ")


def mask_handle(text: Column) -> Column:
    return F.when(text.contains("@"), _replaced(text, ASCII_HANDLE, HANDLE, lexicon.HANDLE_MARK)).otherwise(text)


def mask_hashtag(text: Column) -> Column:
    return F.when(text.contains("#"), F.regexp_replace(text, HASHTAG, lexicon.HASHTAG_MARK)).otherwise(text)


def mask_url(text: Column) -> Column:
    begun = text.contains("http") | text.contains("www.")
    return F.when(begun, F.regexp_replace(text, URL, lexicon.URL_MARK)).otherwise(text)


def mask_markup(text: Column) -> Column:
    return F.when(text.contains("<"), F.regexp_replace(text, MARKUP, lexicon.MARKUP_MARK)).otherwise(text)


def strip_punctuation(text: Column) -> Column:
    return _replaced(text, ASCII_PUNCTUATION, PUNCTUATION, "")


def squeeze_space(text: Column) -> Column:
    return F.trim(_replaced(text, ASCII_BLANKS, f"[{SPACE}]+", " "))


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _replaced(text: Column, ascii_pattern: str, pattern: str, by: str) -> Column:
    """All matches replaced; both patterns match alike in texts of ASCII alone."""
    return F.when(_is_ascii(text), F.regexp_replace(text, ascii_pattern, by)).otherwise(
        F.regexp_replace(text, pattern, by)
    )


def words(text: Column) -> Column:
    """White-space separated words, none of them empty."""
    # Words behind one space each are cut apart without a pattern.
    return F.filter(F.split(_replaced(text, ASCII_BLANKS, f"[{SPACE}]+", " "), " "), lambda word: word != "")


def remove_stop_words(text: Column, stop_words: Iterable[str] = lexicon.STOP_WORDS) -> Column:
    """Drop listed words. The list becomes a hash set in the plan, so each test is O(1)."""
    listed = sorted(set(stop_words))
    _check_inline(listed)
    return F.array_join(F.filter(words(text), lambda word: ~word.isin(listed)), " ")


def expand_contractions(
    text: Column, contractions: Mapping[str, str] = lexicon.CONTRACTIONS
) -> Column:
    """Replace contractions wherever they stand between non-word characters."""
    runs = rf"[{WORD}'’]+|[^{WORD}'’]+"

    def expand(token: Column) -> Column:
        expanded = _map_segments(
            token, runs, contractions, lambda run: F.replace(run, F.lit("’"), F.lit("'"))
        )
        return F.when(token.contains("'") | token.contains("’"), expanded).otherwise(token)

    # No contraction spans a space, so only the few tokens with an apostrophe are taken apart.
    return F.array_join(F.transform(F.split(text, " "), expand), " ")


def describe_emoji(text: Column, emoji: Mapping[str, str] = lexicon.EMOJI) -> Column:
    """Replace each emoji by ``:its name:``; the longest known sequence wins."""
    known = "|".join(sorted(emoji, key=len, reverse=True))
    starts = _ranges({sequence[0] for sequence in emoji})
    segments = f"{known}|[^{starts}]+|[{starts}]"
    described = {sequence: f":{name}:" for sequence, name in emoji.items()}
    return F.when(
        text.rlike(f"[{starts}]"), _map_segments(text, segments, described)
    ).otherwise(text)


def lemmatize(text: Column, lemmas: Mapping[str, str] = lexicon.LEMMAS) -> Column:
    """Replace each space-separated token by its lemma."""
    return F.array_join(F.transform(F.split(text, " "), lambda token: _lookup(token, lemmas)), " ")


def fix_unicode(text: Column) -> Column:
    """Undo UTF-8 text that was decoded as Latin-1; any other text is left alone."""
    suspicious = ~_is_ascii(text) & text.rlike(r"^[\x00-\xff]*+\z") & text.rlike(r"[\xc2-\xf4][\x80-\xbf]")
    repaired = F.try_validate_utf8(F.encode(text, "ISO-8859-1").cast("string"))
    return F.when(suspicious, F.coalesce(repaired, text)).otherwise(text)


def label_code(label: Column) -> Column:
    """``No`` and ``Yes`` as 0 and 1; anything else is null."""
    code = F.lit(None).cast("int")
    for name, value in lexicon.LABEL_CODES.items():
        code = F.when(label == name, F.lit(value)).otherwise(code)
    return code


def _ranges(characters: set[str]) -> str:
    """A character class of at most two ranges that covers ``characters``; a wide set is slow."""
    planes = [
        sorted(c for c in characters if (ord(c) > 0xFFFF) == supplementary)
        for supplementary in (False, True)
    ]
    return "".join(f"{plane[0]}-{plane[-1]}" for plane in planes if plane)


def _map_segments(text, pattern, entries, key=lambda segment: segment):
    segments = F.regexp_extract_all(text, F.lit(pattern), 0)
    return F.array_join(
        F.transform(segments, lambda segment: _lookup(segment, entries, key(segment))), ""
    )


def _lookup(value: Column, entries: Mapping[str, str], key: Column | None = None) -> Column:
    """``entries[key]``, or ``value`` without one; a hash-set test precedes the map scan."""
    _check_inline(entries)
    key = value if key is None else key
    table = F.create_map(*[F.lit(part) for entry in entries.items() for part in entry])
    return F.when(key.isin(list(entries)), F.try_element_at(table, key)).otherwise(value)


def _check_inline(entries) -> None:
    if len(entries) > MAX_INLINE_ENTRIES:
        raise ValueError(
            f"{len(entries)} entries are too many to inline; "
            "pass them as a table to operators.lexicon.rewrite_tokens"
        )
