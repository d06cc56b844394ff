"""License scans: Aho-Corasick over words and tags, and a shunting-yard parser for licence expressions.

One automaton holds the notice phrases, as space-bounded words, and reads the text's normalised words; another
finds identifier tags in the raw text.  The expression after a tag (and / or / with, parentheses) is parsed by
shunting-yard and evaluated on a stack: which licences it names, which of them every way to comply needs, whether
permissive licences alone satisfy it, and its conditions in a canonical form.  Each of these is worked out from those of
the operands, exactly, so alternatives are never multiplied out and need no cap.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cache
from hashlib import blake2b

import ahocorasick
from pyspark.sql import DataFrame

from varloom.llm.common import map_texts

# The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases and their labels.
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "all rights reserved": "all-rights-reserved",
    "licensed under the": "notice",
    "released under the": "notice",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
#: Words are runs of letters, digits and everything beyond ASCII, A-Z lower-cased.
_KEEP = set(b"abcdefghijklmnopqrstuvwxyz0123456789") | set(range(128, 256))
TO_WORDS = bytes(b if b in _KEEP else 32 for b in range(256))
# Public identifiers of licences, in lower case; permissive ones first, then the others.
PERMISSIVE = frozenset(
    """0bsd afl-3.0 apache-1.1 apache-2.0 artistic-2.0 blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent
    bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc0-1.0
    curl ecl-2.0 hpnd icu isc libpng mit mit-0 ms-pl ncsa openssl pddl-1.0 php-3.01 postgresql psf-2.0 python-2.0 ruby
    unicode-3.0 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1""".split()
)
OTHERS = frozenset(
    """agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apsl-2.0 busl-1.1 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0
    cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cddl-1.0 cddl-1.1 cecill-2.1 cpl-1.0 elastic-2.0 epl-1.0 epl-2.0 eupl-1.1
    eupl-1.2 gfdl-1.3-only gfdl-1.3-or-later gpl-1.0 gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only
    gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later ipl-1.0 lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1
    lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later mpl-1.0 mpl-1.1 mpl-2.0 ms-rl odbl-1.0
    ofl-1.1 osl-3.0 qpl-1.0 sspl-1.0""".split()
)
LICENCES = PERMISSIVE | OTHERS
# Public identifiers of exceptions, in lower case.
EXCEPTIONS = frozenset(
    """autoconf-exception-3.0 bison-exception-2.2 classpath-exception-2.0 font-exception-2.0 gcc-exception-2.0
    gcc-exception-3.1 libtool-exception linux-syscall-note llvm-exception openjdk-assembly-exception-1.0
    qt-gpl-exception-1.0 universal-foss-exception-1.0 u-boot-exception-2.0 wxwindows-exception-3.1""".split()
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(TO_WORDS).split()


@cache
def phrase_automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in BASE_PHRASES | MORE_PHRASES:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


@cache
def tag_automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for tag in TAGS:
        found.add_word(tag, tag)
    found.make_automaton()
    return found


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, phrase) of every place, overlaps included."""
    joined = (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass")
    out, at, count = [], 0, 0
    for end, phrase in phrase_automaton().iter(joined):
        start = end - len(phrase) - 1
        if start < at:  # phrases of different lengths may end out of order
            at, count = 0, 0
        count += joined.count(" ", at, start)
        at = start
        out.append((count, phrase))
    return out


# ---- expressions

TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard; None where the text is no expression."""
    out, stack, operand = [], [], False
    for token in TOKEN.findall(expression):
        low = token.lower()
        if low in PRECEDENCE:
            if not operand:
                return None
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = False
        elif token == "(":
            if operand:
                return None
            stack.append(token)
        elif token == ")":
            if not operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif operand:
            break  # the expression has ended, prose follows
        else:
            out.append(low.rstrip(".:-"))  # a full stop after the expression is none of its name
            operand = True
    while stack:
        if stack[-1] == "(":
            return None
        out.append(stack.pop())
    return out if operand else None


def known(name: str) -> bool:
    """Whether a lower-case name is a licence's: a public identifier, also with +, or a reference to one's own text."""
    return name.removesuffix("+") in LICENCES or name.startswith(("licenseref-", "documentref-"))


@dataclass
class Terms:
    """What an expression asks for.  `op` is "and", "or" or, for a single licence, empty; parts are keyed by name."""

    op: str
    parts: dict = field(default_factory=dict)
    licences: set = field(default_factory=set)
    required: set = field(default_factory=set)
    permissive: bool = False

    def key(self) -> str:
        if not self.op:
            return next(iter(self.parts))
        return "~" + blake2b(" ".join((self.op, *sorted(self.parts))).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def single(name: str, exception: str | None = None) -> Terms:
    whole = name if exception is None else f"{name}-with-{exception}"
    sure = {whole} if known(name) and (exception is None or exception in EXCEPTIONS or exception.startswith("additionref-")) else set()
    return Terms("", {whole: None}, set(sure), set(sure), bool(sure) and name.removesuffix("+") in PERMISSIVE)


def larger(a: set | dict, b: set | dict) -> set | dict:
    """Both as one, made by adding the smaller to the larger."""
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    a.update(b)
    return a


def combined(op: str, a: Terms, b: Terms) -> Terms:
    """a op b.  `and` needs what either needs, `or` what both need; equal parts of an operator count once."""
    parts = larger(*(x.parts if x.op in ("", op) else {x.key(): x} for x in (a, b)))
    if op == "and":
        required, permissive = larger(a.required, b.required), a.permissive and b.permissive
    else:
        required, permissive = a.required & b.required, a.permissive or b.permissive
    if len(parts) == 1:  # both sides are the same
        return b
    return Terms(op, parts, larger(a.licences, b.licences), required, permissive)


def terms(expression: str) -> Terms | None:
    """The value of an expression; None for a broken one and for one that names no known licence."""
    stack: list = []
    for token in postfix(expression) or []:
        if token not in PRECEDENCE:
            stack.append(token)  # a name, until an operator tells whether it is a licence or an exception
            continue
        b, a = stack.pop(), stack.pop()
        if token == "with":
            if not (isinstance(a, str) and isinstance(b, str)):
                return None
            stack.append(single(a, b))
        else:
            stack.append(combined(token, *(single(x) if isinstance(x, str) else x for x in (a, b))))
    value = stack[0] if stack else None
    value = single(value) if isinstance(value, str) else value
    return value if value is not None and value.licences else None


def conditions(value: Terms) -> str:
    """The canonical form: names sorted, then groups of the other operator in parentheses, by their digests."""
    out, stack = [], [value]
    while stack:  # no recursion: groups may be nested to any depth
        top = stack.pop()
        if isinstance(top, str):
            out.append(top)
            continue
        pieces: list = []
        for key in sorted(top.parts):
            inner = top.parts[key]
            pieces += [f" {top.op} "] * bool(pieces) + ([key] if inner is None else ["(", inner, ")"])
        stack += reversed(pieces)
    return "".join(out)


def tag_expressions(text: str) -> list[str]:
    """What follows each tag, up to the end of its line."""
    low = text.lower()
    if len(low) != len(text):  # a few letters change length; then the tags are looked for in the lower-cased text
        text = low
    out = []
    for end, _ in tag_automaton().iter(low):
        stop = text.find("\n", end)
        out.append(text[end + 1 : stop if stop >= 0 else len(text)])
    return out


def scan_text(text: str) -> tuple:
    words = words_of(text)
    places = phrase_places(words)
    base = [(i, BASE_PHRASES[p]) for i, p in places if p in BASE_PHRASES]
    labels = {label for _, label in base} | {MORE_PHRASES[p] for _, p in places if p in MORE_PHRASES}
    value = None
    for one in map(terms, tag_expressions(text)):  # the expressions of all tags hold together
        if one is not None:
            value = one if value is None else combined("and", value, one)
    labels |= value.licences if value else set()
    evidence = len(base) + 2 * (value is not None) + 0.25 * (len(places) - len(base))
    starts = [i for i, _ in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), round(1 - 0.5**evidence, 6),
        ",".join(sorted(value.required)) if value else "", conditions(value) if value else "", value.permissive if value else None,
    )


COLUMNS = dict.fromkeys(("n_words", "n_base", "first_word", "last_word"), "long") | {"base_labels": "string", "labels": "string", "score": "double"}
COLUMNS |= {"required": "string", "conditions": "string", "permissive": "boolean"}


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and COLUMNS for every row.

    labels holds the phrases' labels and all known licences that expressions name; required those that every way to
    comply with the expressions needs; conditions their canonical form, unknown names included; permissive whether
    permissive licences alone satisfy them (null without an expression).  An expression that is broken or names no
    known licence counts as none.  Null texts count as empty: no words, no labels (empty strings), score 0.  Null and
    repeated keys keep a row each; other columns are ignored; an empty table gives an empty result.
    """

    def work():
        return lambda texts: (None, list(zip(*map(scan_text, texts))))

    return map_texts(docs, (key,), text, COLUMNS, work)
