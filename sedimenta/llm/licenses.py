"""License scans: one Aho-Corasick pass over the words of a text, and a shunting-yard parser for licence expressions.

The automaton holds the notice phrases and the identifier tag, as words between single spaces. A text that carries
the tag is read again around the tag for its expression (`MIT OR (Apache-2.0 AND GPL-2.0-only WITH ...)`), whose postfix form gives its
licences and what it obliges to: of `or` the reader may choose, `and` binds to both sides, an exception stays with its licence.

Defined results: null is empty; a text without words has n_words 0, no labels and score 0. Rows that repeat an id are scanned each by its text.
Where phrases overlap each counts; labels are sets, so ties don't arise. Texts and expressions of any length are read whole, in linear time. Only
doc_id and text are read; other columns, whatever their names, play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sedimenta.llm.common import blobs, map_rows, read, small_text_batches

# The four base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further notices; their labels never replace base ones.
MORE = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl", "mozilla public license": "mpl",
    "eclipse public license": "epl", "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit", "licensed under the apache license": "apache", "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc0": "cc0", "public domain": "public-domain",
    "all rights reserved": "proprietary", "isc license": "isc", "boost software license": "bsl", "the unlicense": "unlicense",
}
TAG = "spdx license identifier"
#: Word characters: ASCII letters and digits and all that is not ASCII; the rest becomes a space, A-Z lower case.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
TAGGED = re.compile(r"spdx[^a-z0-9\n]*license[^a-z0-9\n]*identifier[^a-z0-9(\n]*", re.I)
TERM = re.compile(r"\n|\(|\)|[A-Za-z0-9][A-Za-z0-9.\-]*\+?")
FAMILY = re.compile(r"^(agpl|lgpl|gpl|apache|mit|bsd|mpl|epl|cc0|cc-by-sa|cc-by-nc|cc-by-nd|cc-by|isc|bsl|unlicense)(?![a-z])")
BINDS = {"or": 1, "and": 2, "with": 3}
#: Labels of licences whose terms go on to works made from theirs.
RECIPROCAL = frozenset(("gpl", "lgpl", "agpl", "mpl", "epl", "cc-by-sa"))


def postfix(tokens: Iterable[str]) -> list[str]:
    """Shunting-yard: `with` binds before `and` before `or`. Reading stops where no expression can go on.

    A line end stops it too, unless a bracket is open or an operator has no right side yet.
    """
    out, stack, operand = [], [], True
    for token in tokens:
        low = token.lower()
        if token == "\n":
            if stack and (operand or "(" in stack):
                continue
            break
        if operand and low not in BINDS and token not in "()":
            out.append(token)
            operand = False
        elif operand and token == "(":
            stack.append("(")
        elif not operand and low in BINDS:
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = True
        elif not operand and token == ")" and "(" in stack:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            break
    if operand and stack and stack[-1] in BINDS:  # an operator without a right side
        stack.pop()
    return out + [x for x in reversed(stack) if x != "("]


def evaluate(rpn: list[str]) -> list[set[str]]:
    """The alternatives of an expression, each the set of licences that hold together; there may be as many as 2 ** operators."""
    stack: list[list[set[str]]] = []
    for token in rpn:
        if token not in BINDS:
            stack.append([{token}])
            continue
        if len(stack) < 2:
            return stack[0] if stack else []
        right, left = stack.pop(), stack.pop()
        if token == "or":
            stack.append(left + [x for x in right if x not in left])
        elif token == "and":
            stack.append([a | b for a in left for b in right])
        else:
            stack.append([{f"{x} with {next(iter(right[0]))}" for x in a} for a in left])
    return stack[0] if stack else []


def obliges(rpn: list[str]) -> bool | None:
    """Whether every alternative of an expression holds a reciprocal licence; null where there is no expression. Linear."""
    stack: list[bool] = []
    for token in rpn:
        if token not in BINDS:
            stack.append(label_of(token) in RECIPROCAL)
            continue
        if len(stack) < 2:
            break
        right, left = stack.pop(), stack.pop()
        stack.append(left and right if token == "or" else left or right if token == "and" else left)
    return stack[0] if stack else None


def licences(rpn: list[str]) -> set[str]:
    """The licences that an expression names, without their exceptions."""
    stack: list[set[str]] = []
    for token in rpn:
        if token not in BINDS:
            stack.append({token})
        elif len(stack) >= 2:
            right, left = stack.pop(), stack.pop()
            if token != "with":
                left |= right
            stack.append(left)
    return stack[0] if stack else set()


def expression(text: str) -> list[set[str]]:
    return evaluate(postfix(found[0] for found in TERM.finditer(text)))


def tagged_expressions(text: str) -> Iterator[list[str]]:
    """The postfix form of what stands after each tag, up to the next one."""
    tags = list(TAGGED.finditer(text))
    for found, after in zip(tags, [*tags[1:], None], strict=True):
        yield postfix(term[0] for term in TERM.finditer(text, found.end(), after.start() if after else len(text)))


def label_of(licence: str) -> str:
    low = licence.lower()
    found = FAMILY.match(low)
    return found[1] if found else low.split(" with ")[0]


def automaton() -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for phrase in {**BASE, **MORE, TAG: ""}:
        auto.add_word(f" {phrase} ", (phrase, len(phrase)))
    auto.make_automaton()
    return auto


def scan(data: bytes, auto: ahocorasick.Automaton) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, obliges (true if an expression leaves no other choice; null without one)."""
    words = data.translate(FOLD).split()
    if not words:
        return 0, 0, None, None, "", "", 0.0, None
    line = f" {b' '.join(words).decode('utf-8', 'replace')} "
    n_base, places, base, labels, tagged, at, word = 0, [], set(), set(), False, 0, 0
    for end, (phrase, length) in auto.iter(line):
        start = end - length
        # Hits come by their end; a longer phrase may start before the last one.
        word = word + line.count(" ", at, start) if start >= at else line.count(" ", 0, start)
        at = start
        if phrase in BASE:
            n_base += 1
            places.append(word - 1)
            base.add(BASE[phrase])
        elif phrase == TAG:
            tagged = True
        else:
            labels.add(MORE[phrase])
    share, bound = 0.0, []
    if tagged:
        for rpn in tagged_expressions(data.decode("utf-8", "replace")):
            found = {label_of(x) for x in licences(rpn)}
            labels |= found
            if found:
                share = 1.0
                bound.append(obliges(rpn))
    labels |= base
    score = max(share, 1 - 0.5 ** (n_base + 0.5 * len(labels - base))) if labels else 0.0
    return len(words), n_base, min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, any(bound) if bound else None


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, obliges boolean"


def license_scan(docs: DataFrame) -> DataFrame:
    small_text_batches(docs.sparkSession)

    def make():
        auto = automaton()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            cols = list(zip(*(scan(t, auto) for t in blobs(batch)), strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.bool_())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[f.split()[0] for f in SCHEMA.split(", ")])

        return step

    return map_rows(docs.select("doc_id", "text"), SCHEMA, make)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents"))
