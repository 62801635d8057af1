"""License scans: an Aho-Corasick automaton finds tags and notice phrases, a shunting-yard parser evaluates expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from emberlog.llm import common

#: Phrases, as lower-case words, and the labels they give.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further phrases of licence notices.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons zero": "cc0",
    "creative commons attribution": "cc-by",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "proprietary",
}
#: The label of a notice that says no more than that rights are reserved.
RESERVED = "proprietary"
TAG = "spdx license identifier"
TAG_SIGN = "spdx-license-identifier"
AFTER_TAG = re.compile(r"[ \t]*:[ \t]*([^\r\n]+)")
VERSION, LATER = r"(?:-v?\d+(?:\.\d+)*)?", r"(?:-only|-or-later)?\+?"
#: Whole licence identifiers, lower case, with label and restrictiveness.
FAMILIES = tuple(
    (re.compile(pattern), label, level)
    for pattern, label, level in (
        (rf"agpl{VERSION}{LATER}", "agpl", 4),
        (rf"lgpl{VERSION}{LATER}", "lgpl", 2),
        (rf"gpl{VERSION}{LATER}", "gpl", 3),
        (rf"apache{VERSION}\+?", "apache", 1),
        (r"mit(?:-0|-cmu|-modern-variant|-open-group)?", "mit", 1),
        (r"bsd(?:-[1-4]-clause(?:-[a-z0-9-]+)?)?", "bsd", 1),
        (r"0bsd", "bsd", 0),
        (r"isc", "isc", 1),
        (rf"mpl{VERSION}(?:-no-copyleft-exception)?\+?", "mpl", 2),
        (rf"epl{VERSION}\+?", "epl", 2),
        (rf"cc0{VERSION}", "cc0", 0),
        (rf"cc-by(?:-nc)?(?:-sa|-nd)?{VERSION}(?:-[a-z]+)?", "cc-by", 1),
        (r"unlicense", "public-domain", 0),
        (r"licenseref-.+|proprietary", "proprietary", 5),
    )
)
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:\-]*")
#: Up to this restrictiveness a text counts as permitted.
PERMITTED = 2
WEIGHTS = {"tag": 0.9, "phrase": 0.6, "notice": 0.5}

LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class Expression(ValueError):
    """Text that isn't a licence expression."""


def postfix(text: str) -> list[str]:
    """Shunting yard: identifiers and operators of an expression in postfix order; with binds before and before or."""
    out: list[str] = []
    stack: list[str] = []
    operand = False  # whether the last token ended an operand
    for token in TOKEN.findall(text):
        word = token.lower()
        if word in PRECEDENCE:
            if not operand:
                raise Expression(text)
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[word]:
                out.append(stack.pop())
            stack.append(word)
            operand = False
        elif token == "(":
            if operand:
                raise Expression(text)
            stack.append(token)
        elif token == ")":
            if not operand:
                raise Expression(text)
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise Expression(text)
            stack.pop()
        elif operand:
            break  # words after a whole expression don't belong to it
        else:
            out.append(token)
            operand = True
    if not operand or "(" in stack:
        raise Expression(text)
    return out + stack[::-1]


def family(identifier: str) -> tuple[str, int]:
    """Label and restrictiveness of an identifier; one that isn't known is unknown and restrictive."""
    low = identifier.lower()
    return next(((label, level) for pattern, label, level in FAMILIES if pattern.fullmatch(low)), ("unknown", 5))


def evaluate(text: str) -> tuple[list[str], int]:
    """Labels and restrictiveness of an expression: or takes the freer side, and the stricter, with an exception frees its licence by one."""
    stack: list[tuple[frozenset[str], int, str]] = []
    for token in postfix(text):
        if token not in PRECEDENCE:
            label, level = family(token)
            stack.append((frozenset([label]), level, token))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left[0], max(0, left[1] - 1), ""))
        else:
            stack.append((left[0] | right[0], (min if token == "or" else max)(left[1], right[1]), ""))
    return sorted(stack[0][0]), stack[0][1]


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, phrases in (("notice", NOTICES), ("tag", {TAG: ""}), ("phrase", BASE)):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (kind, label, len(phrase) + 2))
    found.make_automaton()
    return found


@lru_cache(maxsize=1)
def tag_automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word(TAG_SIGN, len(TAG_SIGN))
    found.make_automaton()
    return found


def tagged(raw: bytes) -> list[str]:
    """Expressions behind identifier tags, each up to the end of its line or to the next tag, so that every byte is read for one tag only."""
    signs = raw.translate(ASCII_LOWER).decode("latin-1")
    ends = [end + 1 for end, _ in tag_automaton().iter(signs)]
    stops = [end - len(TAG_SIGN) for end in ends[1:]] + [len(signs)]
    found = (AFTER_TAG.match(signs, end, stop) for end, stop in zip(ends, stops, strict=False))
    return [raw[m.start(1) : m.end(1)].decode("utf-8", "replace") for m in found if m]


def scan(text: str) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, permitted, places of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.translate(LOWER).split()
    line = b" " + b" ".join(words) + b" "
    hits = [(end - size + 1, kind, label) for end, (kind, label, size) in automaton().iter(line.decode("latin-1"))]
    hits.sort()
    # A hit begins at the space before its first word, so its place is the number of spaces before.
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32) if hits else None
    at = np.searchsorted(spaces, [start for start, _, _ in hits]).tolist() if hits else []
    base = [place for place, (_, kind, _) in zip(at, hits, strict=True) if kind == "phrase"]
    base_labels = sorted({label for _, kind, label in hits if kind == "phrase"})
    labels = {label for _, _, label in hits if label}
    if labels - {RESERVED}:  # beside a licence, reserved rights are a part of its notice
        labels.discard(RESERVED)
    kinds, expressions, levels = {(kind, label) for _, kind, label in hits}, [], []
    if any(kind == "tag" for _, kind, _ in hits):
        for expression in tagged(raw):
            try:
                found, level = evaluate(expression)
            except Expression:
                continue
            expressions.append(" ".join(postfix(expression)))
            labels.update(found)
            levels.append(level)
    missing = 1.0
    for kind, _ in kinds:
        missing *= 1 - (WEIGHTS[kind] if kind != "tag" or expressions else 0)
    return (
        len(words), len(base), base[0] if base else None, base[-1] if base else None, ",".join(base_labels), ",".join(sorted(labels)),
        round(1 - missing, 6), expressions, max(levels) <= PERMITTED if levels else None, [(place, kind, label) for place, (_, kind, label) in zip(at, hits, strict=True)],
    )


NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "permitted", "places")
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, permitted boolean, places array<struct<word: long, kind: string, label: string>>"


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence evidence of every whole text, a row per input row.

    n_words; n_base, first_word, last_word (places of BASE phrases), base_labels; labels (those of notices and of tagged
    expressions too); score; expressions (in postfix order); permitted (by the strictest expression; null without one);
    places of all phrases. Words are ASCII letters and digits, lower-cased, and all characters beyond ASCII.
    A null or empty text has no words, no places (null) and empty labels; an expression that can't be parsed gives no
    label; a null key stays null; repeated rows give a row each; an empty table gives none; other columns are left out.
    No shuffle.
    """
    common.prepare(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.bool_(), pa.list_(pa.struct([("word", pa.int64()), ("kind", pa.string()), ("label", pa.string())]))]
        for batch in batches:
            rows = [scan(t) for t in batch.column(1).to_pylist()]
            columns = [[dict(zip(("word", "kind", "label"), p, strict=True)) for p in r[-1]] for r in rows]
            arrays = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds[:-1])] + [pa.array(columns, kinds[-1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *NAMES])

    return common.keyed(df, id_col, text_col).mapInArrow(run, SCHEMA)
