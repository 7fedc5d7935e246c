"""The cleaning chain as a DataFrame transform.

Steps run in a fixed order. Each step is its own projection: some use their input several
times, and nesting them in one expression would copy that input at every level.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import lexicon, text as T
from postlens.operators import phrases
from postlens.operators.rows import drop_retweets

ALL_STEPS = (
    "retweet",
    "case",
    "contractions",
    "lemmatization",
    "unicode",
    "emoji",
    "stopwords",
    "email",
    "username",
    "hashtags",
    "url",
    "markup",
    "punctuation",
)
DEFAULT_STEPS = ALL_STEPS[1:]
MASKING_STEPS = ("case", "email", "username", "hashtags", "url", "markup", "punctuation")


@dataclass(frozen=True)
class Lexicon:
    """Dictionaries used by the chain: small ones inlined, others as tables of any size.

    A table has the columns ``phrase, replacement`` (stop words: ``phrase``). Its entries may have
    several words; matches are taken from the left, the longest first.
    """

    stop_words: Iterable[str] | DataFrame = tuple(lexicon.STOP_WORDS)
    contractions: Mapping[str, str] | DataFrame = field(default_factory=lambda: lexicon.CONTRACTIONS)
    emoji: Mapping[str, str] | DataFrame = field(default_factory=lambda: lexicon.EMOJI)
    lemmas: Mapping[str, str] | DataFrame = field(default_factory=lambda: lexicon.LEMMAS)

    def table(self, step: str) -> DataFrame | None:
        """The dictionary of a step, if it is a table."""
        used = {"stopwords": self.stop_words, "contractions": self.contractions, "emoji": self.emoji, "lemmatization": self.lemmas}
        return used[step] if isinstance(used.get(step), DataFrame) else None


def clean(
    posts: DataFrame,
    text: str = "text",
    output: str = "prepped_text",
    steps: Iterable[str] = DEFAULT_STEPS,
    words: Lexicon = Lexicon(),
) -> DataFrame:
    """Add the cleaned ``text`` as ``output``; null stays null."""
    chosen = _checked(steps)
    cleaned = (drop_retweets(posts, text) if "retweet" in chosen else posts).withColumn(
        output, F.col(text)
    )
    for step in chosen:
        if (table := words.table(step)) is not None:
            cleaned = _rewritten(step, cleaned, output, table)
        elif step != "retweet":
            cleaned = cleaned.withColumn(output, _apply(step, F.col(output), words))
    return cleaned.withColumn(output, T.squeeze_space(F.col(output)))


def clean_stages(
    posts: DataFrame, text: str, steps: Iterable[str] = DEFAULT_STEPS, words: Lexicon = Lexicon()
) -> DataFrame:
    """Like ``clean``, but keeps the text after every step as ``start`` and one column per step."""
    if any(words.table(step) is not None for step in ALL_STEPS):
        raise ValueError("the texts after each step are kept for inlined dictionaries only")
    staged, previous = posts.withColumn("start", F.col(text)), "start"
    for step in _checked(steps):
        if step == "retweet":
            # A dropped row counts in no later step; its text is null from here on.
            current = F.when(~T.is_retweet(F.col(previous)), F.col(previous))
        else:
            current = _apply(step, F.col(previous), words)
        staged, previous = staged.withColumn(step, current), step
    return staged


def _checked(steps: Iterable[str]) -> list[str]:
    asked = set(steps)
    if unknown := asked - set(ALL_STEPS):
        raise ValueError(f"unknown cleaning steps {sorted(unknown)}")
    return [step for step in ALL_STEPS if step in asked]


def _rewritten(step: str, rows: DataFrame, output: str, table: DataFrame) -> DataFrame:
    """A step by its dictionary table."""
    match step:
        case "contractions":
            straight = lambda segment: F.replace(segment, F.lit("’"), F.lit("'"))
            return phrases.rewrite_phrases(rows, output, table, phrases.by_words, straight)
        case "emoji":
            named = table.select("phrase", F.concat(F.lit(":"), "replacement", F.lit(":")).alias("replacement"))
            return phrases.rewrite_phrases(rows, output, named, phrases.by_symbols)
        case "stopwords":
            words = F.array_join(T.words(F.col(output)), " ")
            dropped = table.select("phrase", F.lit(None).cast("string").alias("replacement"))
            return phrases.rewrite_phrases(rows.withColumn(output, words), output, dropped).withColumn(output, words)
        case _:
            return phrases.rewrite_phrases(rows, output, table)


def _apply(step: str, value: Column, words: Lexicon) -> Column:
    match step:
        case "case":
            return T.lower_case(value)
        case "contractions":
            return T.expand_contractions(value, words.contractions)
        case "lemmatization":
            return T.lemmatize(value, words.lemmas)
        case "unicode":
            return T.fix_unicode(value)
        case "emoji":
            return T.describe_emoji(value, words.emoji)
        case "stopwords":
            return T.remove_stop_words(value, words.stop_words)
        case "email":
            return T.mask_email(value)
        case "username":
            return T.mask_handle(value)
        case "hashtags":
            return T.mask_hashtag(value)
        case "url":
            return T.mask_url(value)
        case "markup":
            return T.mask_markup(value)
        case "punctuation":
            return T.strip_punctuation(value)
