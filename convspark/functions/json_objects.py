"""JSON objects in noisy text, found in one pass."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd

_MARK = re.compile(r'\\.?|["{}]', re.S)


def spans(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(start, end) of every pair of braces that can be an object, in the order of their ends, for two readings.

    An object may start at any brace, and quotes count from there; so a brace is read as outside a string, whatever
    stands before it. Two readings, of opposite sides of every quote, hold all braces: one is outside where the other is
    inside. A backslash is an escape to the one inside, and ends all that the other has open, as no object has one there.
    """
    found, opened, inside = ([], []), ([], []), False
    for m in _MARK.finditer(text):
        at, mark = m.start(), m.group()
        stack = opened[inside]  # of the reading that is outside here
        if mark == '"':
            inside = not inside
        elif mark == "{":
            stack.append(at)
        elif mark == "}":
            if stack:
                found[inside].append((stack.pop(), at + 1))
        else:
            stack.clear()
            if mark == "\\{":
                stack.append(at + 1)
    return found


def objects(text: str) -> list[tuple[int, dict]]:
    """(start, object) of all JSON objects in the text, nested ones too, by their starts.

    Objects inside one that is valid come with it, in the order in which they end; only where one isn't, those inside it
    are tried on their own.
    """
    seen: list[dict] = []

    def note(pairs: list) -> dict:
        seen.append(dict(pairs))
        return seen[-1]

    decoder = json.JSONDecoder(object_pairs_hook=note, parse_constant=lambda _: None)
    out = []
    for ends in spans(text):
        done = 0
        for k in sorted(range(len(ends)), key=lambda i: ends[i]):
            if ends[k][0] < done:
                continue
            seen.clear()
            try:
                decoder.raw_decode(text, ends[k][0])
            except (ValueError, RecursionError):
                continue
            done = ends[k][1]
            out += zip((start for start, _ in ends[k + 1 - len(seen) : k + 1]), list(seen))
    return sorted(out, key=lambda x: x[0])


def summaries(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """(at, body) of each text's objects whose summary is a string, as clean JSON."""
    for batch in texts:
        yield pd.Series([[] if t is None else [{"at": at, "body": json.dumps(o)} for at, o in objects(t) if isinstance(o.get("summary"), str)] for t in batch], dtype=object)
