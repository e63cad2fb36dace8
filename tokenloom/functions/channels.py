"""Advertising channel names."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.text import ColumnLike, blank_to_null, first_text

# Words looked for, in order of precedence, and the channel each stands for.
UTM_CHANNELS = [
    (("unattributed",), None),
    (("organic",), "organic"),
    (("google",), "google"),
    (("tiktok",), "tiktok"),
    (("facebook", "instagram", "messenger"), "facebook"),
    (("kuai", "kwai", "kuaishou"), "kwai"),
]
INSTALL_CHANNELS = [
    (("unattributed",), None),
    (("organic",), "ORGANIC"),
    (("google",), "GG"),
    (("apple",), "ASA"),
    (("tiktok",), "TT"),
    (("facebook", "instagram", "messenger"), "FB"),
    (("sms",), "SMS"),
    (("kuai",), "KW"),
]


def _channel(text: Column, channels: list, otherwise: Column) -> Column:
    lowered = F.lower(text)
    result = F
    for words, name in channels:
        found = reduce(or_, [lowered.contains(word) for word in words])
        result = result.when(found, F.lit(name).cast("string"))
    return result.otherwise(otherwise)


def map_utm_source(network: ColumnLike, tracker: ColumnLike) -> Column:
    text = first_text(network, tracker)
    return _channel(text, UTM_CHANNELS, F.lower(text))


def map_install_source(tracker: ColumnLike) -> Column:
    text = blank_to_null(tracker)
    return _channel(text, INSTALL_CHANNELS, text)
