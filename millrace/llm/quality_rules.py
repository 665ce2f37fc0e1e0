"""Quality rules, lines first: lines that look unlike prose go, and a document that loses too much of itself is rejected.

Each line (`\\n`-split) with a word is judged by itself:

* punctuation: it ends without a closing mark, or symbols or doubled marks stand at more than every fourth word;
* navigation: it is cut by separators, or has at most `NAVIGATION_WORDS` words and opens like a menu entry;
* boilerplate: it has at most `BOILERPLATE_WORDS` words and a customary phrase of page frames, or it equals an earlier line
  of its text.

Lines that fail are taken out.  A document is kept if it passes the base counts (words, and words in repeated windows of
three) and at most `MAX_LOST` of its words stood in failed lines.  Everything is a matter of one row: no shuffle, and a text
of any length is judged whole by one task.

Null texts have no words: all counts are 0, the clean text is null, and they fail as empty ones do.  Rows without an id,
repeated rows and repeated ids are judged each by itself.  An empty table gives an empty table.  All columns of the input
stay; a result column replaces one of the same name.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

from millrace.llm.common import add_columns

MIN_WORDS = 50  # words of a document
MAX_REPEATED = 50  # percent of words in windows found twice or more
MAX_LOST = 30  # percent of words in failed lines
WINDOW = 3  # words
BOILERPLATE_WORDS = 40
NAVIGATION_WORDS = 6
SYMBOLS = "#*$%&|<>"

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
#: The patterns of the line rules are plain enough to mean the same in SQL.
CLOSED = r"[.!?…。！？]['\")\]»”’]*[\x20\x09-\x0D]*$"
DOUBLED = r"[!?]{2}"
SEPARATOR = r"[|»›·•→]"
MENU = r"^[\x20\x09-\x0D]*(home|menu|next|previous|back to top|log in|login|sign in|sign up|read more|share|skip to content)"
FRAME = r"cookie|javascript|privacy policy|terms of use|terms of service|all rights reserved|lorem ipsum|click here|©"
_CLOSED, _DOUBLED, _SEPARATOR, _MENU, _FRAME = map(re.compile, (CLOSED, DOUBLED, SEPARATOR, MENU, FRAME))
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
VERDICT = "clean_text string, n_lines_removed long, lost_words long, kept boolean"


def repeated_words(words: list[str]) -> int:
    """Words that stand in a window found twice or more, the first one included."""
    windows = list(zip(*(words[k:] for k in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, until = Counter(windows), 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + WINDOW - max(at, until)
            until = at + WINDOW
    return covered


def failed_rule(line: str, n_words: int, seen: bool) -> str | None:
    """The rule that a line with words breaks, if any."""
    if not _CLOSED.search(line) or 4 * (len(SYMBOL.findall(line)) + len(_DOUBLED.findall(line))) > n_words:
        return "punctuation"
    if len(_SEPARATOR.findall(line)) >= 2 or n_words <= NAVIGATION_WORDS and _MENU.match(line.translate(_LOWER)):
        return "navigation"
    if seen or n_words <= BOILERPLATE_WORDS and _FRAME.search(line.translate(_LOWER)):
        return "boilerplate"
    return None


def judge_text(text: str | None) -> tuple:
    """The values of `BASE` and `VERDICT` for one text."""
    words = WORD.findall(text or "")
    lines, seen, kept = (text or "").split("\n"), set(), []
    duplicates = lost = removed = 0
    for line in lines:
        n = len(WORD.findall(line))
        if n:
            again = line in seen
            duplicates += again
            seen.add(line)
            if failed_rule(line, n, again):
                lost += n
                removed += 1
                continue
        kept.append(line)
    repeated = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED * len(words)
    return (len(words), sum(map(len, words)), len(SYMBOL.findall(text or "")), duplicates, repeated, base_failed,
            None if text is None else "\n".join(kept), removed, lost, not base_failed and 100 * lost <= MAX_LOST * len(words))


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the base counts, `clean_text` (the text without its failed lines) and the verdict `kept`."""

    def make():
        return lambda batch: list(zip(*map(judge_text, batch.column(text).to_pylist()))) or [[]] * 10

    return add_columns(docs, make, f"{BASE}, {VERDICT}")
