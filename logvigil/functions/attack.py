"""Attack signatures and the classifier built on them."""

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Literal signatures, searched in the lower-cased path. Earlier
# types win. Trailing blanks count.
ATTACK_SIGNATURES: dict[str, tuple[str, ...]] = {
    "SQLi": (
        "' or ",
        "or 1=1",
        "' --",
        "union select",
        "drop table",
        "insert into",
        "sqlmap",
        "' and ",
        "xp_cmdshell",
        "information_schema",
        "sleep(",
        "benchmark(",
        "1=1",
        "' or '1'='1",
    ),
    "XSS": (
        "<script>",
        "javascript:",
        "onerror=",
        "onload=",
        "alert(",
        "<img src",
        "document.cookie",
        "eval(",
        "<iframe",
        "onmouseover=",
        "</script>",
    ),
    "Other": (
        "nikto",
        "../",
        "/etc/passwd",
        "cmd.exe",
        "/bin/bash",
        "wget ",
        "curl ",
        "base64_decode",
        "nmap",
        ".php?id=",
        "../../",
    ),
}
SAMPLE_CHARS = 80


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    """Whether the text holds one of the needles.

    A needle around a shorter one adds nothing to the answer and is not searched.
    """
    needles = sorted(set(needles), key=lambda needle: (len(needle), needle))
    shortest = [
        needle
        for position, needle in enumerate(needles)
        if not any(shorter in needle for shorter in needles[:position])
    ]
    return reduce(or_, (text.contains(needle) for needle in shortest), F.lit(False))


def first_match(text: Column, signatures: Mapping[str, Iterable[str]]) -> Column:
    """First type with a signature in the lower-case text, or NULL."""
    return F.coalesce(
        *[
            F.when(contains_any(text, [needle.lower() for needle in needles]), name)
            for name, needles in signatures.items()
        ]
    )


def attack_type(
    path: Column, signatures: Mapping[str, Iterable[str]] = ATTACK_SIGNATURES
) -> Column:
    """First attack type with a signature in the path, whatever its case, or NULL."""
    return first_match(F.lower(path), signatures)


def path_sample(path: Column, chars: int = SAMPLE_CHARS) -> Column:
    """The part of a path that is kept as a sample, by default as long as the fixed value."""
    return F.substring(path, 1, chars)
