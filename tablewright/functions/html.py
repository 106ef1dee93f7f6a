"""Expressions that read elements, bands and percentages out of HTML text.

All of them are row-local: a page is never split over rows or shuffled to find its
elements. Elements need a stack of what is open, so they are found by one scan per page in
Arrow batches; the rest are built-in expressions.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.values import as_column

# Which elements a start tag ends where their end tag is left out, up to what encloses them.
_BLOCKS = frozenset("""address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table td th tr ul""".split())
_ENDED_BY = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select optgroup"),
    "optgroup": ("option optgroup", "select"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tbody": ("tbody thead tfoot tr td th", "table"), "thead": ("tbody thead tfoot tr td th", "table"),
    "tfoot": ("tbody thead tfoot tr td th", "table"),
}
_ENDED_BY = {tag: (frozenset(ends.split()), frozenset(within.split())) for tag, (ends, within) in _ENDED_BY.items()}
_P, _AROUND_P = frozenset({"p"}), frozenset("table td th div section article li blockquote button form".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
EN_DASH = "–"


def without_scripts(html: str) -> Column:
    """Drop comments, scripts and styles, whose text may look like tags."""
    clean = F.regexp_replace(F.col(html), r"(?s)<!--.*?-->", "")
    clean = F.regexp_replace(clean, r"(?is)<script\b.*?</script\s*>", "")
    return F.regexp_replace(clean, r"(?is)<style\b.*?</style\s*>", "")


#: A tag; the last group, to its end, where each quoted value in it is closed.
_OPEN = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)
    ([^>=]*+(?:=(?:\s*+(?:"[^"]*+"|'[^']*+')|(?!\s*["']))[^>=]*+)*+>)?""", re.X)
_VALUE_OR_END = re.compile(r"""=\s*(["'])|>""")


def _tags(page: str) -> Iterator[tuple[int, int, bool, str]]:
    """(start, end, whether an end tag, name) of all tags; ">" inside a quoted value ends none.

    A quote that is not closed before the page's end is no quote. Each character is looked
    at a fixed number of times: what is missing up to the page's end is missing once.
    """
    at = 0
    while opened := _OPEN.search(page, at):
        at = opened.end()
        while not opened[3]:
            stop = _VALUE_OR_END.search(page, at)
            if stop is None:
                return
            at = stop.end()
            if not stop[1]:
                break
            at = page.find(stop[1], at) + 1
            if not at:
                at = page.find(">", stop.end()) + 1
                if not at:
                    return
                break
        yield opened.start(), at, bool(opened[1]), opened[2].lower()


_CLASS = re.compile(r"""\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def _has_class(mark: str, wanted: str) -> bool:
    if wanted not in mark:  # spares most tags the regular expression
        return False
    found = _CLASS.search(mark)
    value = next((g for g in found.groups() if g is not None), "") if found else ""
    return value == wanted or wanted in value.split()


def scan_elements(page: str, tag: str, class_: str | None = None) -> list[tuple[int, str, str]]:
    """(open, inner, mark) of all elements of a tag, in document order; see `elements`.

    One pass with a stack of the open elements. An end tag also ends what was opened
    inside and left open; one that nothing open matches is ignored.
    """
    tag, stack, count, found = tag.lower(), [], defaultdict(int), []

    def end_at(depth: int, stop: int) -> None:
        while len(stack) > depth:
            name, opened, start, mark = stack.pop()
            count[name] -= 1
            if name == tag and (class_ is None or _has_class(mark, class_)):
                found.append((opened, page[start:stop], mark))

    def end_nearest(names: frozenset, within: frozenset, stop: int) -> bool:
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in names:
                end_at(depth, stop)
                return True
            if stack[depth][0] in within:
                return False
        return False

    for start, stop, ends, name in _tags(page):
        if ends:
            if count[name]:
                if stack[-1][0] == name:
                    end_at(len(stack) - 1, start)
                else:
                    end_nearest(frozenset((name,)), frozenset(), start)
            continue
        if name in _BLOCKS and count["p"]:
            end_nearest(_P, _AROUND_P, start)
        if name in _ENDED_BY:
            names, within = _ENDED_BY[name]
            while any(map(count.get, names)) and end_nearest(names, within, start):
                pass
        if name in _VOID:
            if name == tag and (class_ is None or _has_class(page[start:stop], class_)):
                found.append((start, "", page[start:stop]))
        else:
            stack.append((name, start, stop, page[start:stop] if name == tag else ""))
            count[name] += 1
    end_at(0, len(page))
    return sorted(found)


def check_tag(tag: str) -> None:
    if not tag.isalnum():
        raise ValueError(f"not a tag name: {tag!r}")


#: Bytes of text that are Python objects at a time, besides the last page's.
_PART = 1 << 20


def parts_of(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of rows that hold about ``_PART`` bytes of text."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.flatnonzero(np.diff((np.cumsum(size) - size) // _PART, prepend=-1)).tolist()
    return zip(begins, [*begins[1:], len(size)])


def by_parts(texts: pa.Array, of_one: Callable, kind: pa.DataType) -> pa.Array:
    """``of_one`` of each text; only a part of the batch is Python objects at a time."""
    found = [pa.array([of_one(t) for t in texts[first:end].to_pylist()], kind) for first, end in parts_of(texts)]
    return pa.concat_arrays(found) if found else pa.array([], kind)


def elements(html: Column | str, tag: str, class_: str | None = None) -> Column:
    """All elements of a tag in a column, as array<struct<open, inner, mark>> in document order.

    Elements may be nested. An element without an end tag ends where HTML lets it: at the
    next sibling that cannot be inside it (list items, paragraphs, cells, rows), at its
    parent's end, or at the page's end. ``class_`` is matched as one token of the class
    attribute or as the whole attribute. Each page is read once from start to end.
    """
    check_tag(tag)
    kind = pa.list_(pa.struct([("open", pa.int32()), ("inner", pa.string()), ("mark", pa.string())]))

    @F.arrow_udf("array<struct<open: int, inner: string, mark: string>>")
    def found(pages: pa.Array) -> pa.Array:
        return by_parts(pages, lambda page: [] if page is None else [
            {"open": o, "inner": inner, "mark": mark} for o, inner, mark in scan_elements(page, tag, class_)], kind)

    return found(as_column(html))


_COMMENT, _ANY_TAG = re.compile(r"<!--.*?-->", re.S), re.compile(r"<[^>]*>")
_COMMENT_JVM = r"(?s)<!--.*?-->"
#: An attribute value that holds ">", a quote that is not closed in its tag, or "<" that begins no tag.
_HARD = r"""=\s*(?:"[^">]*>|'[^'>]*>)|<[^>]*<"""


def _without_tags(fragment: str) -> str:
    kept, at = [], 0
    for start, stop, _, _ in _tags(fragment):
        kept.append(fragment[at:start])
        at = stop
    rest = "".join([*kept, fragment[at:]])
    last = rest.rfind(">") + 1  # no tag ends behind it
    return _ANY_TAG.sub("", rest[:last]) + rest[last:]


def plain_text(fragment: str) -> str:
    """Tags dropped, character references decoded; a no-break space reference becomes a space."""
    bare = _without_tags(_COMMENT.sub("", fragment))
    return unescape(bare.replace("&nbsp;", " ")) if "&" in bare else bare


def text_of(html: Column | str) -> Column:
    """Text of an HTML column: tags dropped, all character references decoded.

    Built-in expressions do it; only fragments with a character reference, ">" in an
    attribute value or "<" that begins no tag are read in Arrow batches.
    """
    @F.arrow_udf("string")
    def texts(fragments: pa.Array) -> pa.Array:
        return by_parts(fragments, lambda t: None if t is None else plain_text(t), pa.string())

    fragment = as_column(html)
    bare = F.regexp_replace(F.regexp_replace(fragment, _COMMENT_JVM, ""), "<[^>]*>", "")
    hard = fragment.contains("&") | fragment.rlike(_HARD)
    return F.when(hard, texts(F.when(hard, fragment))).otherwise(bare)


def nth_text(html: Column | str, tag: str, n: int) -> Column:
    """Text of the n-th (from 0) element of a tag; null when there are fewer."""
    return text_of(F.get(elements(html, tag), F.lit(int(n)))["inner"])


def parse_band(text: Column | str, bound: str, top: float = 200.0) -> Column:
    """Lower or upper bound of an age band written "25-34" (en dash) or "75+"."""
    text = as_column(text)
    closed = rf"(\d{{2}}){EN_DASH}(\d{{2}})"
    group = {"lo": 1, "hi": 2}[bound]
    within = F.regexp_extract(text, closed, group)
    open_end = F.regexp_extract(text, r"(\d{2})\+", 1)
    last = open_end.try_cast("double") if bound == "lo" else F.lit(float(top))
    return F.when(within != "", within.try_cast("double")).when(open_end != "", last)


def has_open_end(text: Column | str) -> Column:
    """True for a band without upper bound, such as "75+"."""
    return as_column(text).rlike(r"\d{2}\+")


def parse_percent(text: Column | str) -> Column:
    """The number between "(" and "%"; null when there is none."""
    return F.regexp_extract(as_column(text), r"\(([0-9.]+)%", 1).try_cast("double")
