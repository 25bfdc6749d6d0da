"""Dialect-neutral regular expressions rendered for the JVM engine.

The fixed patterns are written with ``\\b \\w \\s``, whose meaning differs between
engines. Here they always mean: word = letter, digit or underscore of any script;
space = any Unicode space or an information separator; ``.`` = all but line feed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = r"\p{L}\p{N}_"
_SPACE = r"\s\x1c-\x1f"
_BEFORE = f"(?<![{_WORD}])"
_AFTER = f"(?![{_WORD}])"
_EITHER = f"(?:(?<=[{_WORD}]){_AFTER}|{_BEFORE}(?=[{_WORD}]))"


def _boundary(pattern: str, at: int) -> str:
    follows = pattern[at + 2:at + 3]
    if pattern[at - 1:at] == "}":
        return _EITHER          # what precedes may end in a separator
    if follows in ("", ".", "|", ")"):
        return _AFTER
    # test for a digit first: most positions fail there without looking back
    digit_led = re.match(r"\\b(\(\?:)?\\d", pattern[at:])
    return rf"(?=\d){_BEFORE}" if digit_led else _BEFORE


def jvm(pattern: str, ignore_case: bool = False) -> str:
    """Java form of ``pattern``: Unicode classes, and only ``\\n`` ends a line."""
    out, in_class, i = [], False, 0
    while i < len(pattern):
        two = pattern[i:i + 2]
        if two == r"\b":
            out.append(_boundary(pattern, i))
        elif two == r"\w":
            out.append(_WORD if in_class else f"[{_WORD}]")
        elif two == r"\s":
            out.append(_SPACE if in_class else f"[{_SPACE}]")
        elif two == r"\S":
            out.append(f"[^{_SPACE}]")
        elif two.startswith("\\"):
            out.append(two)
        else:
            if two[0] == "[":
                in_class = True
            elif two[0] == "]":
                in_class = False
            out.append(two[0])
            i += 1
            continue
        i += 2
    return ("(?Uidu)" if ignore_case else "(?Ud)") + "".join(out)


# fixed values: where text breaks into lines (Python's str.splitlines)
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}]"


# Letters outside ASCII that equal an ASCII letter when case is ignored, but whose lower
# case is not that letter: long s, dotless i, capital dotted i.
_ODD_CASE = ("\u017f", "\u0131", "\u0130")


def folded(text: Column) -> Column:
    """What case-insensitive fragment search needs, to be computed once per text.

    ``lower`` is the text in lower case; ``odd`` tells that it holds an odd-case letter,
    for which lower case is no proof, so the pattern itself has to decide.
    """
    odd = reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in _ODD_CASE])
    return F.struct(F.lower(text).alias("lower"), odd.alias("odd"))


def may_match(text: Column, needs: Sequence[Sequence[str]], fold: Column | None = None) -> Column:
    """Cheap necessary condition of a pattern, by plain substring search.

    Substring search costs a fraction of a regular expression, and most texts hold none of
    the fragments. Given ``fold``, the fragments (in lower case) are searched ignoring case.
    """
    where = text if fold is None else fold["lower"]
    found = [reduce(lambda a, b: a & b, [F.contains(where, F.lit(f)) for f in fragments])
             for fragments in needs]
    if fold is not None:
        found.append(fold["odd"])
    return reduce(lambda a, b: a | b, found)


def literal(text: str) -> str:
    return re.escape(text)
