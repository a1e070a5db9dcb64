"""HTML as expressions: elements, attributes, anchors, visible text.

There is no tree.  A whole element is found by counting opening and closing tags of its
name; simpler forms cut at the next tag where elements are known to hold none of their
own.  Every pattern is linear in the page, with possessive loops where a loop over
alternatives is needed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.binding import bind
from linkloom.functions.text import strip

MARK = "\u0001"

# The attributes of an opening tag: quoted values may hold any character.
_ATTRS = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+"""
_HIDDEN = r"<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)"
_TAG = r"</?[a-z]" + _ATTRS + r">|<[!?][^>]*>"
_HIDDEN_OR_TAG = r"(?is)" + _HIDDEN + "|" + _TAG
_ENTITY = r"^&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _entity_table() -> Column:
    pairs = [(name, chr(code)) for name, code in name2codepoint.items()] + [("apos", "'")]
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def _code_point(name: Column) -> Column:
    digits = F.regexp_extract(name, r"^#([0-9]+)$", 1)
    hex_digits = F.regexp_extract(name, r"^#[xX]([0-9a-fA-F]+)$", 1)

    def decoded(as_hex: Column) -> Column:
        number = F.conv(as_hex, 16, 10).cast("bigint")
        valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(as_hex, 8, "0")), "UTF-32"))

    return bind(
        F.when(digits != "", F.hex(digits.try_cast("bigint"))).otherwise(hex_digits), decoded
    )


def _decode_piece(piece: Column) -> Column:
    def replaced(name: Column) -> Column:
        char = F.when(F.startswith(name, F.lit("#")), _code_point(name)).otherwise(
            F.try_element_at(_entity_table(), name)
        )
        rest = F.substring(piece, F.length(name) + 3, F.length(piece))
        return F.coalesce(F.concat(char, rest), piece)

    return F.when(
        F.startswith(piece, F.lit("&")), bind(F.regexp_extract(piece, _ENTITY, 1), replaced)
    ).otherwise(piece)


def decode_entities(text: Column) -> Column:
    """Replace named and numeric character references, each once."""
    return bind(
        text,
        lambda t: F.when(
            F.contains(t, F.lit("&")),
            F.array_join(F.transform(F.split(t, "(?=&)"), _decode_piece), ""),
        ).otherwise(t),
    )


def drop_hidden(html: Column) -> Column:
    """Remove scripts, styles and comments."""
    return F.regexp_replace(html, "(?is)" + _HIDDEN, "")


def visible_text(html: Column) -> Column:
    """Text nodes, stripped, empties dropped, joined by one space; null gives ''."""
    marked = F.regexp_replace(html, _HIDDEN_OR_TAG, MARK)
    nodes = F.transform(F.split(marked, MARK), lambda x: strip(decode_entities(x)))
    return F.coalesce(F.array_join(F.filter(nodes, lambda x: x != ""), " "), F.lit(""))


def inner_text(fragment: Column) -> Column:
    """All text of a fragment, concatenated and not stripped."""
    return decode_entities(F.regexp_replace(fragment, _HIDDEN_OR_TAG, ""))


@dataclass(frozen=True)
class Selector:
    """A tag, optionally with one attribute test.

    ``value`` is an exact attribute value, ``token`` one word of a class list (a
    token with a space means the whole value), ``pattern`` a regular expression that
    is searched in the value.  With only ``attr`` the attribute must be present.
    """

    tag: str
    attr: str | None = None
    value: str | None = None
    token: str | None = None
    pattern: str | None = None


def opening_tag(element: Column) -> Column:
    """The opening tag at the start of an element."""
    return F.regexp_extract(element, r"(?is)^(<[a-z]" + _ATTRS + r">)", 1)


def _attr_pattern(name: str) -> str:
    value = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
    other = r"""(?:[\s/]++(?!%s[\s=/>])[^\s=>/"']++(?:\s*+=\s*+%s)?+)*+""" % (name, value)
    wanted = r"(%s(?:\s*+=\s*+%s)?+)" % (name, value)
    return r"(?is)^<[a-z][^\s/>]*+" + other + r"[\s/]++" + wanted


def attribute(element: Column, name: str) -> Column:
    """Attribute value of an element's opening tag; null when absent, '' when empty."""
    found = F.regexp_extract(element, _attr_pattern(name), 1)
    return bind(
        found,
        lambda raw: F.when(
            raw != "",
            decode_entities(F.regexp_replace(raw, r"""^[^=]*+(?:=\s*+["']?)?|["']$""", "")),
        ),
    )


def matches(element: Column, selector: Selector) -> Column:
    """Whether an element satisfies the selector's attribute test."""
    if selector.attr is None:
        return F.lit(True)

    def test(actual: Column) -> Column:
        if selector.value is not None:
            return actual == selector.value
        if selector.token is not None and " " in selector.token:
            return actual == selector.token
        if selector.token is not None:
            return F.array_contains(F.split(actual, r"\s+"), selector.token)
        if selector.pattern is not None:
            return F.rlike(actual, F.lit(selector.pattern))
        return actual.isNotNull()

    return F.coalesce(bind(attribute(element, selector.attr), test), F.lit(False))


def starting_tags(html: Column, tag: str) -> Column:
    """The page cut at every opening ``tag``: one piece per tag, in page order."""
    pieces = F.split(html, r"(?i)(?=<" + tag + r"[\s/>])")
    return F.filter(pieces, lambda p: F.rlike(p, F.lit(r"(?i)^<" + tag + r"[\s/>]")))


def until_close(element: Column, tag: str) -> Column:
    """The element up to its first closing tag."""
    return F.regexp_replace(element, r"(?is)</" + tag + r"[\s>].*$", "")


def flat_elements(html: Column, selector: Selector) -> Column:
    """Elements that hold none of their own tag, each up to its closing tag."""
    found = F.filter(starting_tags(html, selector.tag), lambda p: matches(p, selector))
    return F.transform(found, lambda p: until_close(p, selector.tag))


def inside(element: Column) -> Column:
    """What follows the opening tag of an element."""
    return F.regexp_replace(element, r"(?is)^<[a-z]" + _ATTRS + ">", "")


#: Running sums are built in blocks of this many: an array of n costs n * SUM_BLOCK + (n / SUM_BLOCK)**2 steps.
SUM_BLOCK = 128


def running_sums(values: Column) -> Column:
    """The sum of an array's integers up to each."""

    def summed(block: Column, start: Column) -> Column:
        grown = F.aggregate(
            block, F.array(start), lambda seen, v: F.array_append(seen, F.element_at(seen, -1) + v)
        )
        return F.slice(grown, 2, SUM_BLOCK)

    def whole(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda t, v: t + v))
        starts = F.aggregate(
            totals, F.array(F.lit(0)), lambda seen, t: F.array_append(seen, F.element_at(seen, -1) + t)
        )
        return F.flatten(F.zip_with(blocks, F.slice(starts, 1, F.size(blocks)), summed))

    last = F.floor((F.size(values) - 1) / SUM_BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * SUM_BLOCK + 1, SUM_BLOCK))
    return F.when(F.size(values) > 0, bind(blocks, whole)).otherwise(F.array().cast("array<int>"))


def whole_elements(html: Column, tag: str, wanted: Callable[[Column], Column]) -> Column:
    """Elements whose opening tag is ``wanted``, in page order, nested ones too.

    Opening and closing tags of the name give a running depth; an element ends before
    the tag where the depth falls below its own, or at the page's end.  The tags that cross
    one depth are by turns opening and closing ones, so among all tags in order of depth and
    place an element's end is the next: each tag is looked at once.
    """

    def found(parts: Column) -> Column:
        opens = F.transform(parts, lambda p: F.rlike(p, F.lit(r"(?i)^<" + tag + r"[\s/>]")))
        closes = F.transform(parts, lambda p: F.rlike(p, F.lit(r"(?i)^</" + tag + r"[\s>]")))
        steps = F.zip_with(
            opens, closes, lambda o, c: F.when(o, 1).when(c, -1).otherwise(0)
        )
        return bind(steps, lambda step: bind(running_sums(step), lambda depth: cut(parts, step, depth)))

    def cut(parts: Column, steps: Column, depths: Column) -> Column:
        # The depth a tag crosses: the one after an opening tag, the one before a closing tag.
        crossings = F.transform(
            F.arrays_zip(steps.alias("step"), depths.alias("depth")),
            lambda t, i: F.struct(
                F.when(t["step"] == 1, t["depth"]).otherwise(t["depth"] + 1).alias("level"), i.alias("at"), t["step"].alias("step")
            ),
        )
        tags = F.array_sort(F.filter(crossings, lambda t: t["step"] != 0))
        return bind(tags, lambda tag_: slices(parts, tag_))

    def slices(parts: Column, tags: Column) -> Column:
        following = F.slice(tags, 2, F.size(tags))
        ends = F.zip_with(
            tags,
            following,
            lambda t, n: F.when(
                t["step"] == 1,
                F.struct(t["at"].alias("at"), F.when(n["level"] == t["level"], n["at"]).otherwise(F.size(parts)).alias("end")),
            ),
        )
        own = F.filter(ends, lambda e: e.isNotNull() & wanted(F.get(parts, e["at"])))
        return F.transform(F.array_sort(own), lambda e: F.array_join(F.slice(parts, e["at"] + 1, e["end"] - e["at"]), ""))

    return bind(F.split(html, r"(?i)(?=</?" + tag + r"[\s/>])"), found)


def selected(html: Column, selector: Selector) -> Column:
    """Whole elements that a selector matches."""
    return whole_elements(html, selector.tag, lambda e: matches(e, selector))
