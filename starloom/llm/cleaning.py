"""Line-first cleaning: rules per line, then documents that lost too much."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What separates words, and what counts as a symbol.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

_SYMBOL = re.compile(r"[#*$%&|<>{}\\^~=_]{2,}|[#$%&<>{}\\^~]")
_SHOUT = re.compile(r"[!?]{2,}$")
_ENDS = re.compile(r"[.!?…:;。！？][\"'”’»)\]]*$")
_BREAK = re.compile(r"\s*[|»›•·→]\s*|\s+[>/]\s+")
_LETTER = re.compile(r"[^\W\d_]")
BOILERPLATE = re.compile(
    r"all rights reserved|cookie (?:policy|settings)|we use cookies|accept (?:all )?cookies|privacy policy"
    r"|terms (?:of|and) (?:use|service|conditions)|enable javascript|javascript is (?:disabled|required)"
    r"|click here|read more|sign (?:in|up)\b|log ?in\b|subscribe (?:now|to)|share (?:on|this)|follow us|back to top"
    r"|skip to (?:main )?content|lorem ipsum",
    re.IGNORECASE,
)


@dataclass(frozen=True)
class Rules:
    """Thresholds of the rules; shares are of a line's words, the last two of a document's."""

    most_symbol_words: float = 0.3
    most_shouted: float = 0.3
    menu_breaks: int = 3  # separators from which a line may be a menu or a table row
    menu_words: float = 3.0  # words between two separators, on average, up to which it is one
    short_line: int = 2  # words up to which a line needs an end of sentence
    boilerplate_words: int = 20  # words up to which a boilerplate phrase fails a line
    fewest_words: int = 50
    most_repeated: float = 0.5
    most_lost: float = 0.5  # share of words in failed lines, above which a document is rejected


def line_fails(line: str, rules: Rules) -> str | None:
    """The rule that a line with words fails: punctuation, navigation, boilerplate, or None."""
    words = line.split()
    if not words:
        return None
    breaks = _BREAK.split(line.strip())
    if len(breaks) > rules.menu_breaks and len(words) / len(breaks) <= rules.menu_words:
        return "navigation"
    if not _LETTER.search(line):
        return "punctuation"
    if sum(_SYMBOL.search(w) is not None for w in words) > rules.most_symbol_words * len(words):
        return "punctuation"
    if len(words) > rules.short_line and sum(_SHOUT.search(w) is not None for w in words) > rules.most_shouted * len(words):
        return "punctuation"
    if len(words) <= rules.short_line and not _ENDS.search(line.rstrip()):
        return "navigation"
    if len(words) <= rules.boilerplate_words and BOILERPLATE.search(line):
        return "boilerplate"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which the text holds twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    _, windows, times = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    again = np.concatenate([times[windows] > 1, [False, False]])
    again[1:] |= again[:-1].copy()
    again[2:] |= np.concatenate([times[windows] > 1, [False, False]])[:-2]
    return int(again.sum())


def judge(text: str, rules: Rules) -> tuple[int, int, int, int, int, bool, bool, int, str]:
    """What the rules say of one text; the last two are the words lost with failed lines and the text without them."""
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = text.split("\n")
    seen: set[str] = set()
    copies = lost = 0
    kept = []
    for line in lines:
        if not line.strip(BLANKS):
            kept.append(line)
            continue
        copies += line in seen
        seen.add(line)
        if line_fails(line, rules):
            lost += len(line.encode("utf-8", "replace").split())
        else:
            kept.append(line)
    repeats = repeated_words(words)
    base = n < rules.fewest_words or repeats > rules.most_repeated * n
    return n, chars, symbols, copies, repeats, base, not base and lost <= rules.most_lost * n, lost, "\n".join(kept)


_SCHEMA = (
    "n_words:bigint, word_chars:bigint, n_symbols:bigint, n_dup_lines:bigint, n_repeat_words:bigint, "
    "base_failed:boolean, kept:boolean, n_lost_words:bigint, clean_text:string"
)


def clean(docs: DataFrame, rules: Rules = Rules(), with_text: bool = True) -> DataFrame:
    """Add the counts, the verdict and the text without failed lines to documents; their own columns stay.

    Null texts have no words, and documents without words or with fewer than `fewest_words` fail. Repeated rows are judged
    each. Added columns take the place of ones that are named like them.
    """
    fields = [f for f in _SCHEMA.split(", ") if with_text or not f.startswith("clean_text")]

    @F.pandas_udf(f"struct<{','.join(fields)}>")
    def judged(texts: pd.Series) -> pd.DataFrame:
        rows = [judge(t or "", rules)[: len(fields)] for t in texts]
        return pd.DataFrame(rows, columns=[f.split(":")[0] for f in fields])

    found = docs.withColumn("__judged", judged("text"))
    added = {f.split(":")[0] for f in fields}
    return found.select(*[f"`{c}`" for c in docs.columns if c not in added], "__judged.*")


def op6(docs: DataFrame) -> DataFrame:
    return clean(docs.select("doc_id", "text"), with_text=False).drop("text")
