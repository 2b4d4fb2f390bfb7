"""Codes of document tables."""

from __future__ import annotations

import re
from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F


class Classification(Enum):
    PUBLIC = "PUBLIC"
    NOT_PROTECTED = "NOT_PROTECTED"
    PROTECTED = "PROTECTED"
    CRITICAL = "CRITICAL"


class DocumentType(Enum):
    KNOWLEDGE = "KNOWLEDGE"
    NEWS = "NEWS"


class ContentType(Enum):
    PRIVATE = 0
    PUBLIC = 1
    MIXED = 2


class LoadType(Enum):
    FULL = "FULL"
    DELTA = "DELTA"
    INCREMENTAL = "INCREMENTAL"


class ServiceLevel(Enum):
    MISSION_CRITICAL = "mission critical"
    BUSINESS_CRITICAL = "business critical"
    BUSINESS_IMPORTANT = "business important"
    BUSINESS_SUPPORT = "business support"


#: Two-letter codes of common languages; more can be passed wherever a table is taken.
LANGUAGES = {
    "ar": "Arabic", "bg": "Bulgarian", "cs": "Czech", "da": "Danish", "de": "German", "el": "Greek", "en": "English", "es": "Spanish", "et": "Estonian", "fi": "Finnish",
    "fr": "French", "he": "Hebrew", "hi": "Hindi", "hr": "Croatian", "hu": "Hungarian", "id": "Indonesian", "it": "Italian", "ja": "Japanese", "ko": "Korean", "lt": "Lithuanian",
    "lv": "Latvian", "nl": "Dutch", "no": "Norwegian", "pl": "Polish", "pt": "Portuguese", "ro": "Romanian", "ru": "Russian", "sk": "Slovak", "sl": "Slovenian", "sv": "Swedish",
    "th": "Thai", "tr": "Turkish", "uk": "Ukrainian", "vi": "Vietnamese", "zh": "Chinese",
}


def member_name(name: str) -> str:
    """A language's or country's name as an identifier: without brackets and what stands in them, words only."""
    return re.sub(r"\W+", "", re.sub(r"\(.*?\)", "", name))


def language_name(column: Column, table: dict[str, str] | None = None) -> Column:
    """The name of a code or of a name in any case; null for what the table lacks."""
    known = table or LANGUAGES
    pairs = [x for code, name in known.items() for key in (code, name.lower()) for x in (F.lit(key), F.lit(name))]
    return F.try_element_at(F.create_map(*pairs), F.lower(column))


#: Schemes of each kind of address.
SCHEMES = {"http": ("http", "https"), "cloud": ("gs", "s3", "s3a", "abfs", "abfss"), "ftp": ("ftp", "ftps", "sftp"), "file": ("file",)}


def is_url(column: Column, *kinds: str) -> Column:
    """Whether a text is an address of one of the kinds (all of them without any); files need no host."""
    schemes = [s for k in kinds or SCHEMES for s in SCHEMES[k]]
    hosted = "|".join(s for s in schemes if s != "file")
    pattern = "|".join(p for p in (rf"(?:{hosted})://[^/\s?#]+(?:[/?#]\S*)?" if hosted else "", r"file://\S+" if "file" in schemes else "") if p)
    return F.coalesce(column.rlike(rf"(?i)^(?:{pattern})$"), F.lit(False))
