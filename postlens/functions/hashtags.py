"""Hashtag arrays: ``array<map<string,string>>`` with a ``text`` entry per tag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_texts(hashtags: Column) -> Column:
    """The texts of one hashtag array; a missing array is empty, a missing text is dropped."""
    texts = F.filter(F.transform(hashtags, lambda tag: tag["text"]), lambda text: text.isNotNull())
    return F.coalesce(texts, F.array().cast("array<string>"))


def all_tags(own: Column, reposted: Column) -> Column:
    """Own tags before reposted ones, repeated texts dropped after their first position."""
    return F.array_distinct(F.concat(tag_texts(own), tag_texts(reposted)))


def normal_tag(tag: Column) -> Column:
    """Lower case without one leading ``#``, the form in which tags are compared."""
    return F.regexp_replace(F.lower(tag), "^#", "")
