"""Elements of pages by tag, class, attribute and nesting, and objects in scripts; built-in expressions only.

A page is cut into tokens: tags, comments, whole scripts and styles, and text. A fold over the tags keeps the open
elements; one ends at its own close tag, at that of an element around it, where another tag implies its end (``li``
before ``li``, ``p`` before a block), or with the page. ``parse`` does this once; selectors look through its elements,
so keep what it gives in a column of its own.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"""(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|</?[a-z!?](?:[^>"']++|"[^"]*+"|'[^']*+'){0,400}+>|</?[a-z!?][^>]*+>|[^<]++|<"""
# Elements without content, those whose end a new tag implies, and what lists and tables keep apart.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "script", "style")
BLOCKS = ("address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul")
IMPLIED = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tr": ("td", "th", "tr", "p"), "option": ("option",)} | {b: ("p",) for b in BLOCKS}
# Character references by name.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "aacute": "á", "eacute": "é", "iacute": "í", "oacute": "ó", "uacute": "ú", "Aacute": "Á", "Eacute": "É", "Iacute": "Í", "Oacute": "Ó", "Uacute": "Ú",
    "ntilde": "ñ", "Ntilde": "Ñ", "uuml": "ü", "Uuml": "Ü", "iexcl": "¡", "iquest": "¿", "laquo": "«", "raquo": "»", "ordm": "º", "ordf": "ª", "deg": "°", "middot": "·", "bull": "•", "ndash": "–", "mdash": "—", "hellip": "…",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "euro": "€", "copy": "©", "reg": "®",
}


def _literal(x: object) -> str:
    """A constant of texts, tuples and dicts as SQL, so that it is one expression."""
    if isinstance(x, dict):
        return "map(" + ", ".join(_literal(v) for pair in x.items() for v in pair) + ")"
    if isinstance(x, tuple):
        return "array(" + ", ".join(map(_literal, x)) + ")"
    return "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def decoded(c: Column) -> Column:
    """A text with its character references resolved; unknown ones stay."""
    table = F.expr(_literal(ENTITIES))

    def one(piece: Column) -> Column:
        digits = F.coalesce(F.conv(F.nullif(F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]{1,6});$", 1), F.lit("")), 16, 10), F.nullif(F.regexp_extract(piece, r"^&#(\d{1,7});$", 1), F.lit(""))).cast("int")
        valid = (digits > 0) & (digits < 0x110000) & ~digits.between(0xD800, 0xDFFF)
        code = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(digits), 8, "0")), "UTF-32"))
        name = F.try_element_at(table, F.regexp_extract(piece, r"^&(\w+);$", 1))
        return F.when(F.substring(piece, 1, 1) == "&", F.coalesce(code, name, piece)).otherwise(piece)

    pieces = lambda t: F.regexp_extract_all(t, F.lit(r"(?s)&#?\w{1,10};|[^&]++|&"), F.lit(0))
    return let(c, lambda t: F.when(F.contains(t, F.lit("&")), F.array_join(F.transform(pieces(t), one), "")).otherwise(t))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, the first of that name; null if it has none, '' for one without a value."""
    given = F.regexp_extract_all(tag, F.lit(r"""(?s)[^\s"'<>/=][^\s"'>/=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+"""), F.lit(0))
    named = F.filter(given, lambda a: F.regexp_like(a, F.lit(rf"(?is)^{re.escape(name)}(?:\s*=|$)")))
    value = F.regexp_replace(F.regexp_replace(F.get(named, F.lit(0)), r"(?s)^[^=]*=?\s*", ""), r"""^["']|["']$""", "")
    return decoded(value)


_STEP = re.compile(r"""(?P<name>[a-z][a-z0-9]*)?(?P<classes>(?:\.[\w-]+)*)(?P<rest>(?:\[[\w-]+(?:[*]?=(?:'[^']*'|"[^"]*"|[^\]]*))?\])*)$""")


def _matches(step: str, e: Column) -> Column:
    """Whether an element fits one step of a selector: ``name``, ``.class``, ``[attr]``, ``[attr=x]``, ``[attr*=x]``, in that order."""
    parts = _STEP.match(step)
    if not step or not parts:
        raise ValueError(f"not a step of a selector: {step!r}")
    tests = [e["name"] == parts["name"]] if parts["name"] else []
    for c in filter(None, parts["classes"].split(".")):
        classes = F.split(attribute(e["tag"], "class"), r"\s+")
        tests.append(F.contains(e["tag"], F.lit(c)) & F.coalesce(F.array_contains(classes, c), F.lit(False)))
    for attr, how, value in re.findall(r"\[([\w-]+)(?:([*]?=)([^\]]*))?\]", parts["rest"]):
        found, value = attribute(e["tag"], attr), value.strip("'\"")
        fits = found.isNotNull() if not how else F.coalesce(F.contains(found, F.lit(value)) if how == "*=" else found == value, F.lit(False))
        tests.append(F.contains(F.lower(e["tag"]), F.lit(attr.lower())) & fits)
    return reduce(lambda a, b: a & b, tests)


def _elements(tokens: Column) -> Column:
    """(i, j) of every element: its tag's token and the one that ends it; in the order of the page."""
    implied, void, none = F.expr(_literal(IMPLIED)), F.expr(_literal(VOID)), F.expr("cast(array() as array<string>)")
    named = F.transform(tokens, lambda t, i: F.struct(F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][a-zA-Z0-9:-]*)", 1)).alias("name"), (~t.startswith("</")).alias("opens"), i.alias("i")))
    tags = F.filter(named, lambda x: x["name"] != "")
    events = F.transform(tags, lambda x: F.struct(x["name"].alias("name"), x["opens"].alias("opens"), x["i"].alias("i"), F.array_contains(void, x["name"]).alias("void"), F.when(x["opens"], F.coalesce(F.try_element_at(implied, x["name"]), none)).otherwise(none).alias("implied")))
    state = F.struct(F.array().cast("array<struct<name:string,i:int>>").alias("open"), F.array().cast("array<struct<i:int,j:int>>").alias("done"))

    def ended(open_: Column, n: Column, at: Column) -> Column:
        return F.transform(F.slice(open_, F.size(open_) - n + 1, n), lambda x: F.struct(x["i"].alias("i"), at.alias("j")))

    def step(acc: Column, e: Column) -> Column:
        back = F.reverse(acc["open"])
        close = F.array_position(F.transform(back, lambda x: x["name"]), e["name"]).cast("int")  # 0: not open
        kept = F.array_position(F.transform(back, lambda x: F.array_contains(e["implied"], x["name"])), F.lit(False)).cast("int")
        pops = F.when(~e["opens"], close).when(F.size(e["implied"]) == 0, F.lit(0)).when(kept == 0, F.size(back)).otherwise(kept - 1)

        def moved(n: Column) -> Column:
            left = F.when(n > 0, F.slice(acc["open"], F.lit(1), F.size(acc["open"]) - n)).otherwise(acc["open"])
            done = F.when(n > 0, F.concat(acc["done"], ended(acc["open"], n, e["i"]))).otherwise(acc["done"])
            more = F.concat(left, F.array(F.struct(e["name"].alias("name"), e["i"].alias("i"))))
            single = F.concat(done, F.array(F.struct(e["i"].alias("i"), e["i"].alias("j"))))
            return F.struct(F.when(e["opens"] & ~e["void"], more).otherwise(left).alias("open"), F.when(e["opens"] & e["void"], single).otherwise(done).alias("done"))

        return let(pops, moved)

    return F.array_sort(F.aggregate(events, state, step, lambda acc: F.concat(acc["done"], ended(acc["open"], F.size(acc["open"]), F.size(tokens)))))


def parse(html: Column | str) -> Column:
    """A page as struct(tokens, elements); an element is struct(name, tag, i, j). Null for a null page."""

    def elements(tokens: Column) -> Column:
        tag = lambda x: F.get(tokens, x["i"])
        name = lambda x: F.lower(F.regexp_extract(tag(x), r"^<([a-zA-Z][a-zA-Z0-9:-]*)", 1))
        return F.struct(tokens.alias("tokens"), F.transform(_elements(tokens), lambda x: F.struct(name(x).alias("name"), tag(x).alias("tag"), x["i"].alias("i"), x["j"].alias("j"))).alias("elements"))

    page = F.col(html) if isinstance(html, str) else html
    return F.when(page.isNotNull(), let(F.regexp_extract_all(page, F.lit(TOKEN), F.lit(0)), elements))


def _inside(x: Column, box: Column) -> Column:
    return (x["i"] > box["i"]) & (x["j"] <= box["j"])


def _fits(steps: list[str], around: Column | None, box: Column | None) -> Callable[[Column], Column]:
    def test(e: Column) -> Column:
        own = reduce(lambda a, b: a | b, [_matches(s, e) for s in steps])
        within = own if box is None else own & _inside(e, box)
        return within if around is None else within & F.exists(around, lambda b: _inside(e, b))

    return test


def select(page: Column | str, selector: str, box: Column | None = None) -> Column:
    """HTML-2: the elements of a parsed page that a selector names, in the order of the page; with ``box`` those in that element.

    A selector is steps with blanks between them (an element within another), each a name, classes, attributes; a step
    may be several with commas: ``div.card-body ul li``, ``[data-cy*='price'],.price``.
    """
    page = F.col(page) if isinstance(page, str) else page
    found: Column | None = None
    for step in selector.split():
        found = F.filter(page["elements"], _fits(step.split(","), found, box))
    return found


def first(page: Column | str, selector: str, box: Column | None = None) -> Column:
    """The first such element, or null."""
    return F.get(select(page, selector, box), F.lit(0))


def _pieces(page: Column | str, e: Column, but: Column | None = None) -> Column:
    """The pieces of text in an element, those of scripts and comments left out, and of the element ``but``.

    The element is looked up once, however often its ends are asked for.
    """
    page = F.col(page) if isinstance(page, str) else page
    text = lambda t: ~F.regexp_like(t, F.lit("^<[a-zA-Z/!?]"))

    def of(e: Column) -> Column:
        inner = F.when(e["j"] > e["i"] + 1, F.slice(page["tokens"], e["i"] + 2, e["j"] - e["i"] - 1)).when(e.isNotNull(), F.array().cast("array<string>"))
        if but is None:
            return F.filter(inner, text)
        return F.filter(inner, lambda t, k: text(t) & F.coalesce((k + e["i"] + 1 < but["i"]) | (k + e["i"] + 1 > but["j"]), F.lit(True)))

    return let(e, of)


def whole_text(page: Column | str, e: Column) -> Column:
    """The text of an element as it stands, without white space at both ends."""
    return strip(decoded(F.array_join(_pieces(page, e), "")))


def joined_text(page: Column | str, e: Column, but: Column | None = None) -> Column:
    """The pieces of text of an element, each without white space at its ends, joined with blanks; without those of ``but``."""
    return F.array_join(F.filter(F.transform(_pieces(page, e, but), lambda p: strip(decoded(p))), lambda p: p != ""), " ")


def last_of_equal_keys(pairs: Column) -> Column:
    """A map from struct(k, v) pairs: of equal keys the last value, at the place of the first."""
    none = F.array().cast("array<struct<k:string,v:string>>")

    def put(acc: Column, p: Column) -> Column:
        known = F.exists(acc, lambda q: q["k"] == p["k"])
        return F.when(known, F.transform(acc, lambda q: F.when(q["k"] == p["k"], F.struct(q["k"].alias("k"), p["v"].alias("v"))).otherwise(q))).otherwise(F.concat(acc, F.array(F.struct(p["k"].alias("k"), p["v"].alias("v")))))

    return F.map_from_entries(F.aggregate(F.filter(pairs, lambda p: p["k"].isNotNull()), none, put))


def object_after(text: Column | str, key: str, before: tuple[str, ...] = ()) -> Column:
    """JSON-2: the JSON object after ``"key":`` by balanced braces, as text; null if it has no end.

    Braces in strings and escaped quotes do not count. With ``before`` the object has to be followed by one of these keys.
    """
    source = F.col(text) if isinstance(text, str) else text
    rest = F.regexp_extract(source, rf'(?s)"{re.escape(key)}"\s*:\s*(\{{.*)', 1)
    tokens = F.regexp_extract_all(rest, F.lit(r'(?s)\\.|"|[{}]|[^"\\{}]++|\\'), F.lit(0))
    state = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(0).alias("n"), F.lit(False).alias("ended"))

    def step(acc: Column, t: Column) -> Column:
        quoted = F.when(t == '"', ~acc["quoted"]).otherwise(acc["quoted"])
        depth = F.when(acc["quoted"], acc["depth"]).when(t == "{", acc["depth"] + 1).when(t == "}", acc["depth"] - 1).otherwise(acc["depth"])
        return F.when(acc["ended"], acc).otherwise(F.struct(depth.alias("depth"), quoted.alias("quoted"), (acc["n"] + 1).alias("n"), (depth == 0).alias("ended")))

    def cut(found: Column) -> Column:
        after = F.array_join(F.slice(found["tokens"], found["end"]["n"] + 1, F.lit(64)), "")
        follows = F.regexp_like(after, F.lit(r'(?s)^\s*,\s*"(?:' + "|".join(map(re.escape, before)) + ')"')) if before else F.lit(True)
        return F.when(found["end"]["ended"] & follows, F.array_join(F.slice(found["tokens"], F.lit(1), found["end"]["n"]), ""))

    return let(let(tokens, lambda ts: F.struct(ts.alias("tokens"), F.aggregate(ts, state, step).alias("end"))), cut)
