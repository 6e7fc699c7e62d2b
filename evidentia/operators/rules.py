"""Detection rules compiled to boolean columns: filter pseudocode, and Sigma detections.

Predicates are two-valued: on a null only != holds, so that `not` keeps its everyday meaning.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.blanks import two_valued

Resolve = Callable[[str], Column]

LEXEMES = re.compile(r"""\s*(?:(?P<op>==|!=|>=|<=|=|>|<)|(?P<punct>[()\[\],])|"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<word>[^\s()\[\],=!<>"']+))""")


def fields_of(rows: DataFrame, native: str | None = "native") -> Resolve:
    """A field is a column of that name, else an entry of the native bag, else null."""
    names = {c.lower(): c for c in rows.columns}

    def resolve(field: str) -> Column:
        found = names.get(field.lower())
        if found:
            return F.col(f"`{found}`").cast("string")
        return F.try_element_at(native, F.lit(field)) if native and native in rows.columns else F.lit(None).cast("string")

    return resolve


def glob_body(pattern: str) -> str:
    """Regular expression of a pattern in which * stands for anything and %name% for an expanded variable."""
    parts = re.split(r"(\*|%\w+%)", pattern)
    return "".join(".*" if p == "*" or re.fullmatch(r"%\w+%", p) else re.escape(p) for p in parts)


def compared(value: Column, op: str, right: str) -> Column:
    """One comparison: equality ignores case and knows globs, a bare name also equals the last component of a path."""
    if op == "match":
        return two_valued(value.rlike(f"(?i){right}"))
    if op in ("=", "==", "!="):
        if "*" in right or re.search(r"%\w+%", right):
            equal = value.rlike(f"(?is)^{glob_body(right)}\\z")
        else:
            equal = F.lower(value) == right.lower()
            if right and not re.search(r"[\\/]", right):
                equal = equal | F.lower(value).endswith("\\" + right.lower()) | F.lower(value).endswith("/" + right.lower())
        return ~two_valued(equal) if op == "!=" else two_valued(equal)
    try:
        number = float(right)
    except ValueError:
        number = None
    test = {">": Column.__gt__, ">=": Column.__ge__, "<": Column.__lt__, "<=": Column.__le__}[op]
    by_text = test(value, F.lit(right))
    if number is None:
        return two_valued(by_text)
    cast = value.try_cast("double")
    return two_valued(F.when(cast.isNotNull(), test(cast, F.lit(number))).otherwise(by_text))


class Filter:
    """Parser of filter text: or, and, not, parentheses, field OP value, field in [list], field match pattern."""

    def __init__(self, text: str, resolve: Resolve):
        self.items: list[tuple[str, str]] = []
        at = 0
        text = text.rstrip()
        while at < len(text):
            m = LEXEMES.match(text, at)
            if not m:
                raise ValueError(f"not a filter at {text[at : at + 20]!r}")
            kind = m.lastgroup or ""
            self.items.append(("text" if kind in ("dq", "sq") else kind, m[kind]))
            at = m.end()
        self.at, self.resolve = 0, resolve

    def peek(self, *words: str) -> bool:
        return self.at < len(self.items) and self.items[self.at][0] != "text" and self.items[self.at][1].lower() in words

    def take(self) -> str:
        if self.at == len(self.items):
            raise ValueError("the filter ends too soon")
        self.at += 1
        return self.items[self.at - 1][1]

    def parse(self) -> Column:
        out = self.either()
        if self.at != len(self.items):
            raise ValueError(f"unexpected {self.items[self.at][1]!r}")
        return out

    def either(self) -> Column:
        out = self.both()
        while self.peek("or"):
            self.take()
            out = out | self.both()
        return out

    def both(self) -> Column:
        out = self.single()
        while self.peek("and"):
            self.take()
            out = out & self.single()
        return out

    def single(self) -> Column:
        if self.peek("not"):
            self.take()
            return ~self.single()
        if self.peek("("):
            self.take()
            out = self.either()
            if self.take() != ")":
                raise ValueError("a parenthesis is not closed")
            return out
        field = self.take()
        op = self.take().lower()
        if op == "in":
            if self.take() not in "[(":
                raise ValueError("in needs a list")
            out, right = F.lit(False), self.take()
            while right not in "])":
                if right != ",":
                    out = out | compared(self.resolve(field), "==", right)
                right = self.take()
            return out
        if op not in ("=", "==", "!=", ">", ">=", "<", "<=", "match"):
            raise ValueError(f"{op!r} is no comparison")
        return compared(self.resolve(field), op, self.take())


def compile_filter(text: str, resolve: Resolve) -> Column:
    return Filter(text, resolve).parse()


#: Words of pseudocode that need more than one row.
DEFERRED = re.compile(r"\b(join|group by|count|sequence|within|followed by)\b", re.I)


def runnable(text: str) -> bool:
    """Whether a rule can be judged row by row."""
    return not DEFERRED.search(text)


def sigma_leaf(value: Column, modifiers: list[str], wanted: object) -> Column:
    """One value of a Sigma field under its modifiers; unknown modifiers make it false."""
    known = {"contains", "startswith", "endswith", "re", "exact", "all", "windash"}
    if wanted is None:
        return value.isNull() | (value == "")
    if set(modifiers) - known:
        return F.lit(False)
    text = str(wanted)
    if "re" in modifiers:
        return two_valued(value.rlike(f"(?i){text}"))
    body = "".join(".*" if p == "*" else "." if p == "?" else re.escape(p) for p in re.split(r"([*?])", text))
    before = ".*" if {"contains", "endswith", "windash"} & set(modifiers) else ""
    after = ".*" if {"contains", "startswith", "windash"} & set(modifiers) else ""
    return two_valued(value.rlike(f"(?is)^{before}{body}{after}\\z"))


def sigma_selection(block: object, resolve: Resolve, keywords: list[str] = ()) -> Column:
    """A map is the conjunction of its fields, a list the disjunction of its entries, a plain text a keyword."""
    if isinstance(block, Mapping):
        out = F.lit(True)
        for key, wanted in block.items():
            field, *modifiers = key.split("|")
            leaves = [sigma_leaf(resolve(field), modifiers, w) for w in (wanted if isinstance(wanted, list) else [wanted])]
            joined = leaves[0]
            for leaf in leaves[1:]:
                joined = joined & leaf if "all" in modifiers else joined | leaf
            out = out & joined
        return out
    if isinstance(block, list):
        out = F.lit(False)
        for one in block:
            out = out | sigma_selection(one, resolve, keywords)
        return out
    out = F.lit(False)
    for k in keywords:
        out = out | sigma_leaf(resolve(k), ["contains"], block)
    return out


def compile_sigma(detection: Mapping, resolve: Resolve, keywords: list[str] = ()) -> Column:
    """A detection's condition over its selections: and, or, not, parentheses, `1 of`, `any of`, `all of` with wildcards."""
    blocks = {k: sigma_selection(v, resolve, keywords) for k, v in detection.items() if k != "condition"}
    words = re.findall(r"\(|\)|[^\s()]+", str(detection["condition"]))
    at = 0

    def quantified(every: bool, pattern: str) -> Column:
        names = [n for n in blocks if pattern == "them" or re.fullmatch(re.escape(pattern).replace(r"\*", ".*"), n)]
        out = F.lit(every and bool(names))
        for n in names:
            out = out & blocks[n] if every else out | blocks[n]
        return out

    def single() -> Column:
        nonlocal at
        word = words[at]
        at += 1
        if word == "not":
            return ~single()
        if word == "(":
            out = either()
            at += 1
            return out
        if word in ("1", "any", "all") and words[at : at + 1] == ["of"]:
            at += 2
            return quantified(word == "all", words[at - 1])
        return blocks[word]

    def both() -> Column:
        nonlocal at
        out = single()
        while words[at : at + 1] == ["and"]:
            at += 1
            out = out & single()
        return out

    def either() -> Column:
        nonlocal at
        out = both()
        while words[at : at + 1] == ["or"]:
            at += 1
            out = out | both()
        return out

    out = either()
    if at != len(words):
        raise ValueError(f"unexpected {words[at]!r} in a condition")
    return out


def hits(rows: DataFrame, rules: Mapping[str, Column], keep: list[str]) -> DataFrame:
    """A row for every rule that a row meets, in one scan over all rules."""
    found = F.filter(F.array(*(F.when(test, F.lit(name)) for name, test in rules.items())), lambda n: n.isNotNull())
    return rows.select(*keep, F.explode(found).alias("rule"))


def stix_equalities(pattern: Column) -> Column:
    """(path, value) pairs of the unnegated equalities of an indicator pattern."""
    paths = F.regexp_extract_all(pattern, F.lit(r"([\w-]+:[\w.'-]+)\s*=\s*'[^']*'"), F.lit(1))
    values = F.regexp_extract_all(pattern, F.lit(r"[\w-]+:[\w.'-]+\s*=\s*'([^']*)'"), F.lit(1))
    return F.arrays_zip(paths.alias("path"), values.alias("value"))
