"""Licence scan: an Aho-Corasick automaton over words, and licence expressions.

The text's A-Z is lower-cased and cut into words (digits, letters and everything beyond ASCII).
One automaton finds, in one pass and overlaps included, all of these word sequences:

* the base phrases;
* names of licences, some of which speak for themselves ("apache license version 2 0") while
  others ("mit", "zlib") mean a licence only inside an expression;
* openers: the identifier tag "spdx license identifier" and notice phrases ("licensed under").

Behind an opener stands a licence expression: names joined by and / or / with, with
parentheses.  A shunting-yard parser (with binds before and, and before or) reads as far as the
tokens make an expression; the longest whole prefix counts.  Its value is its terms: of an `or`
the licensee may choose the laxer side, an `and` obliges to the stricter one, and a linking
exception makes strong copyleft weak.

A document's ``score`` is the noisy-or of the strengths of its distinct findings, its ``terms``
the strictest that any finding asks for.  Offsets are words, from 0.  A null or empty text has no
words and no findings; very long texts are read whole (only the text behind an opener is cut into
expression tokens, up to where the expression ends); repeated rows give equal rows; an empty table
gives no rows; other columns are carried unless they have one of the new names.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from episcope.llm.common import small_batches

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

TERMS = ("permissive", "weak copyleft", "strong copyleft", "non-commercial")

# Identifiers of the public SPDX list, their terms, the names that stand for them by
# themselves, and the names that do so only in an expression.  The identifier's own words are
# always such a name.
LICENCES = {
    "mit": (0, ["mit license", "mit licence"], ["mit"]),
    "apache-2.0": (0, ["apache license version 2 0", "apache license 2 0", "apache software license version 2 0"], ["apache 2", "apache license", "apache"]),
    "bsd-2-clause": (0, ["bsd 2 clause license", "simplified bsd license"], ["2 clause bsd"]),
    "bsd-3-clause": (0, ["bsd 3 clause license", "new bsd license", "modified bsd license"], ["3 clause bsd", "bsd license", "bsd"]),
    "isc": (0, ["isc license"], []),
    "zlib": (0, ["zlib license"], []),
    "unlicense": (0, ["the unlicense"], []),
    "0bsd": (0, ["zero clause bsd"], []),
    "bsl-1.0": (0, ["boost software license"], []),
    "cc0-1.0": (0, ["cc0 1 0 universal", "creative commons zero"], ["cc0"]),
    "cc-by-4.0": (0, ["creative commons attribution 4 0 international"], ["creative commons attribution 4 0"]),
    "cc-by-sa-4.0": (1, ["creative commons attribution sharealike 4 0", "creative commons attribution share alike 4 0"], []),
    "cc-by-nc-4.0": (3, ["creative commons attribution noncommercial 4 0", "creative commons attribution non commercial 4 0"], []),
    "cc-by-nc-sa-4.0": (3, [], []),
    "cc-by-nd-4.0": (1, [], []),
    "cc-by-nc-nd-4.0": (3, [], []),
    "mpl-2.0": (1, ["mozilla public license version 2 0", "mozilla public license 2 0", "mozilla public license"], []),
    "epl-2.0": (1, ["eclipse public license 2 0", "eclipse public license"], []),
    "lgpl-2.1": (1, ["gnu lesser general public license version 2 1"], ["lgplv2 1", "lgpl 2 1 only"]),
    "lgpl-2.1-or-later": (1, [], ["lgpl 2 1 or later"]),
    "lgpl-3.0": (1, ["gnu lesser general public license version 3", "gnu lesser general public license"], ["lgplv3", "lgpl 3", "lgpl", "lgpl 3 0 only"]),
    "lgpl-3.0-or-later": (1, [], ["lgpl 3 0 or later"]),
    "gpl-2.0": (2, ["gnu general public license version 2"], ["gplv2", "gpl 2", "gpl version 2", "gpl 2 0 only"]),
    "gpl-2.0-or-later": (2, ["gnu general public license version 2 or later"], ["gpl 2 0 or later"]),
    "gpl-3.0": (2, ["gnu general public license version 3"], ["gplv3", "gpl 3", "gpl version 3", "gpl 3 0 only", "gnu general public license", "gnu gpl", "gpl"]),
    "gpl-3.0-or-later": (2, ["gnu general public license version 3 or later"], ["gpl 3 0 or later"]),
    "agpl-3.0": (2, ["gnu affero general public license version 3", "gnu affero general public license"], ["agplv3", "agpl 3", "agpl", "agpl 3 0 only"]),
    "agpl-3.0-or-later": (2, [], ["agpl 3 0 or later"]),
}
# Exceptions of the public SPDX list that follow `with`.
EXCEPTIONS = ("classpath-exception-2.0", "gcc-exception-3.1", "llvm-exception", "linux-syscall-note", "autoconf-exception-3.0",
              "bison-exception-2.2", "font-exception-2.0", "openssl-exception")
TAGS = ("spdx license identifier",)
NOTICES = ("licensed under", "released under", "distributed under", "available under", "dual licensed under", "covered by")
FILLERS = frozenset({"the", "a", "an", "either", "both", "terms", "of", "license", "licence", "licenses"})
STRENGTH = {"base": 0.5, "name": 0.7, "notice": 0.9, "tag": 0.95}

_KEPT = "0123456789abcdefghijklmnopqrstuvwxyz"
_TO_WORDS = bytes(b if b >= 0x80 or chr(b) in _KEPT else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_ENDS = {"tag": re.compile(r"[.;](?=\s|$)|\n|\*/"), "notice": re.compile(r"[.;:!?](?=\s|$)|\n\s*\n")}     # of an expression
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
FOUND = "array<struct<label:string,start:long>>"
EXPRESSIONS = "array<struct<start:long,end:long,kind:string,expression:string,terms:string>>"


def _words_of(identifier: str) -> str:
    return " ".join(re.findall("[0-9a-z]+", identifier))


def patterns() -> dict[str, list[tuple[str, str]]]:
    """Word sequence -> what it is: (base | name | operand | exception | tag | notice, label)."""
    out: dict[str, list[tuple[str, str]]] = {}
    for phrase, label in BASE.items():
        out.setdefault(phrase, []).append(("base", label))
    for label, (_, names, inside) in LICENCES.items():
        for name in names:
            out.setdefault(name, []).append(("name", label))
        for name in dict.fromkeys([*names, *inside, _words_of(label)]):
            out.setdefault(name, []).append(("operand", label))
    for label in EXCEPTIONS:
        out.setdefault(_words_of(label), []).append(("exception", label))
    for kind, phrases in (("tag", TAGS), ("notice", NOTICES)):
        for phrase in phrases:
            out.setdefault(phrase, []).append((kind, ""))
    return out


_AUTOMATON: list = []


def automaton():
    """The worker's automaton over " word word " strings (built once per Python worker)."""
    if not _AUTOMATON:
        import ahocorasick
        a = ahocorasick.Automaton()
        for phrase, means in patterns().items():
            a.add_word(f" {phrase} ", (len(phrase.split()), means))
        a.make_automaton()
        _AUTOMATON.append(a)
    return _AUTOMATON[0]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def hits(words: list[bytes]):
    """(first word, word behind the last, meanings) of every pattern found, by end."""
    joined = f" {b' '.join(words).decode()} "
    at, seen = 0, 0                                          # words begun before character `at`
    for end, (n, means) in automaton().iter(joined):
        seen += joined.count(" ", at, end)
        at = end
        yield seen - n, seen, means


def tokens(text: str, spans: list[tuple[int, int]], first: int, kind: str, names: dict):
    """(kind, value, first word, word behind) tokens from word ``first`` on, up to the first word
    or mark that belongs to no expression.  ``names``: word -> (word behind, kind, label)."""
    i = first
    while True:
        gap = text[spans[i - 1][1]:spans[i][0] if i < len(spans) else None]
        end = _ENDS[kind].search(gap)
        for c in gap[:end.start()] if end else gap:
            if c in "()":
                yield "open" if c == "(" else "close", c, i, i
        if end or i >= len(spans):
            return
        word = text[spans[i][0]:spans[i][1]]
        if i in names:
            behind, what, label = names[i]
            if text[spans[behind - 1][1]:spans[behind - 1][1] + 1] == "+" and label + "-or-later" in LICENCES:
                label += "-or-later"
            yield what, label, i, behind
            i = behind
        elif word in PRECEDENCE:
            yield "operator", word, i, i + 1
            i += 1
        elif word in FILLERS:
            i += 1
        else:
            return


def parse(found) -> tuple[list, list[tuple[str, str]]] | None:
    """Shunting-yard over :func:`tokens`: (tokens used, reverse Polish order) of the longest prefix
    that is a whole expression, or None."""
    read: list = []
    out: list[tuple[str, str]] = []
    operators: list[str] = []
    depth, ready, whole = 0, False, None             # ready: an operand has just been read
    for token in found:
        kind, value = token[:2]
        exception = bool(operators) and operators[-1] == "with" and not ready
        if not ready and kind == ("exception" if exception else "operand"):
            out.append((kind, value))
            ready = True
        elif kind == "open" and not ready and not exception:
            operators.append("(")
            depth += 1
        elif kind == "close" and ready and depth:
            while operators[-1] != "(":
                out.append(("operator", operators.pop()))
            operators.pop()
            depth -= 1
        elif kind == "operator" and ready and (value != "with" or out[-1][0] == "operand" and read[-1][0] == "operand"):
            while operators and operators[-1] != "(" and PRECEDENCE[operators[-1]] >= PRECEDENCE[value]:
                out.append(("operator", operators.pop()))
            operators.append(value)
            ready = False
        else:
            break
        read.append(token)
        if ready and depth == 0:                     # at most one operator of each precedence is open here
            whole = len(read), len(out), operators[::-1]
    if whole is None:
        return None
    return read[:whole[0]], out[:whole[1]] + [("operator", o) for o in whole[2]]


def evaluate(order: list[tuple[str, str]]) -> int:
    """Terms (an index into TERMS) of an expression in reverse Polish order."""
    stack: list[int] = []
    for kind, value in order:
        if kind == "operand":
            stack.append(LICENCES[value][0])
        elif kind == "exception":
            stack.append(1)
        else:
            right, left = stack.pop(), stack.pop()
            stack.append(min(left, right) if value != "and" else max(left, right))
    return stack[0]


def scan_text(raw: bytes) -> dict:
    """Findings of one text, as the columns that :func:`scan` adds."""
    words = words_of(raw)
    base, names, openers, inside = [], set(), [], {}
    for start, behind, means in hits(words):
        for kind, label in means:
            if kind == "base":
                base.append({"label": label, "start": start})
            elif kind == "name":
                names.add(label)
            elif kind in ("tag", "notice"):
                openers.append((behind, kind))
            elif start not in inside or inside[start][0] < behind:
                inside[start] = behind, kind, label
    expressions = []
    if openers and inside:
        text = raw.decode().translate(_LOWER)
        spans = [m.span() for m in _WORD.finditer(text)]
        for first, kind in sorted(set(openers)):
            got = parse(tokens(text, spans, first, kind, inside))
            if got:
                used, order = got
                expressions.append((kind, [t[1] for t in used if t[0] == "operand"], evaluate(order),
                                    {"start": first, "end": max(t[3] for t in used), "kind": kind, "expression": " ".join(t[1] for t in used)}))
    own = {x["label"] for x in base}
    labels = own | names | {label for e in expressions for label in e[1]}
    evidence = {("base", x) for x in own} | {("name", x) for x in names} | {(e[0], x) for e in expressions for x in e[1]}
    doubt = 1.0
    for kind, _ in sorted(evidence):
        doubt *= 1 - STRENGTH[kind]
    in_expression = {x for e in expressions for x in e[1]}
    terms = [e[2] for e in expressions] + [LICENCES[x][0] for x in names - in_expression]
    return {"n_words": len(words), "base": sorted(base, key=lambda x: (x["start"], x["label"])), "base_labels": sorted(own),
            "labels": sorted(labels), "expressions": [{**e[3], "terms": TERMS[e[2]]} for e in expressions],
            "terms": TERMS[max(terms)] if terms else None, "score": 1 - doubt}


NEW = {"n_words": "long", "base": FOUND, "base_labels": "array<string>", "labels": "array<string>", "expressions": EXPRESSIONS,
       "terms": "string", "score": "double"}


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, base (label and start of every base phrase, by start), base_labels and
    labels (distinct, sorted), expressions, terms and score."""
    cols = [c for c in docs.columns if c.lower() not in NEW]
    src = docs.select(*cols)
    out_type = T.StructType([*src.schema.fields, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in NEW.items()]])
    at = cols.index(text)
    longs = [("start", pa.int64()), ("end", pa.int64())]
    kinds = [pa.int64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())])), pa.list_(pa.string()), pa.list_(pa.string()),
             pa.list_(pa.struct([*longs, *[(x, pa.string()) for x in ("kind", "expression", "terms")]])), pa.string(), pa.float64()]

    def run(batches):
        for b in small_batches(batches):
            found = [scan_text(t or b"") for t in b.column(at).cast(pa.binary()).to_pylist()]
            new = [pa.array([f[n] for f in found], k) for n, k in zip(NEW, kinds)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*cols, *NEW])

    return src.mapInArrow(run, out_type)
