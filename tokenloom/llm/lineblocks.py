"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines, one for each block; page furniture leaves empty lines. Text
lengths are summed over a sliding window of lines; text is kept between the points where
the sums surge and where they dive.

Furniture is what elements, roles and names say: a ``header`` is one wherever it stands, in an
article too. Names alone mean less inside an article: all parts of a name must speak of furniture or
of nothing, so "ad-box" goes and "social-science" stays. Null html is an empty page; a tag without
an end ends at the next one. The time grows with the length of the page, whatever its markup.
"""

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines of a window, and so the empty lines that furniture leaves.
WINDOW = 3
#: Characters of a window at which text surges, outside and inside an element marked as main text.
SURGE = 80
SURGE_MAIN = 1

# Fixed values of HTML: elements without content, with raw content, and those that start a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split())
MAIN = frozenset(["article", "main"])
#: Blocks that are parts of the element around them.
PARTS = frozenset(
    "address blockquote caption center dd details dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr legend li ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that hold no article text, and names that mark others as such.
FURNITURE = frozenset(
    "nav header footer aside form menu dialog button select option datalist svg math canvas audio video object map "
    "search head".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search menu menubar dialog alertdialog alert form".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended cookie cookies consent gdpr "
    "notice notification popup modal overlay newsletter subscribe subscription signup login share sharing social comment "
    "comments discussion disqus replies reply respond form hidden alert toast disclaimer pagination pager toolbar topbar "
    "adsbygoogle adbox adslot commentlist commentform mainmenu sidenav topnav navmenu cookiebar".split())

#: Words that say nothing of the content: inside an article a name means furniture only if the rest of it is of these.
GENERIC = frozenset(
    "area article articles bar bottom box button buttons cell col column container content embed form group icon icons inline inner "
    "item items left link links list main outer page panel post posts row right section site slot stories story text thread top "
    "unit wrap wrapper".split())
#: Lists of other pages: "more" before one of these.
MORE = frozenset("articles links news pages posts reading stories".split())

#: Names that say what a page has or lacks: the words beside them name no furniture.
MODIFIERS = frozenset("has no not with without".split())
SWITCHES = frozenset("enabled disabled supported".split())
#: Names of what readers write, which may well be more than the text of the page.
REPLIES = frozenset("comment comments discussion disqus replies reply respond commentlist commentform".split())

# A tag without an end ends where the next one starts, so that no search goes beyond the next start of a tag.
_LOOSE = r"<(?![a-zA-Z/!?])"
_TAG = re.compile(
    rf"""<!--|<[!?]|<(/?)([a-zA-Z][^\s/<>]*+)"""
    rf"""((?:[^<>"']++|{_LOOSE}|"(?:[^"<]++|{_LOOSE})*+"|'(?:[^'<]++|{_LOOSE})*+'|["'])*+)(?:>|(?=<))""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _names(named: str, whole: bool) -> set[str]:
    """Names of furniture among the parts of names such as "side-bar", "cookieBanner" or "ad_2".

    Modifiers and what they belong to do not count. With ``whole``, a name counts only if all its parts say so or
    nothing: "ad-box" does, "social-science" does not.
    """
    found = set()
    for word in named.split():
        parts = [part.lower() for part in _NAME.findall(word)]
        if not parts or parts[-1] in SWITCHES:
            continue
        parts = parts[: next((i for i, part in enumerate(parts) if part in MODIFIERS), len(parts))]
        if any(a == "more" and b in MORE for a, b in zip(parts, parts[1:])):
            found.add("related")
        if not whole or all(part in FURNITURE_NAMES or part in GENERIC for part in parts):
            found.update(FURNITURE_NAMES.intersection(parts))
    return found


def _furniture(name: str, attributes: str, whole: bool) -> str:
    """Empty if no furniture; "sure", or "named" or "replies" where only names or a form say so: these may wrap a whole page."""
    kinds = {"named"} if name == "form" else {"sure"} if name in FURNITURE else set()
    if name in ("html", "body") or not attributes.strip():
        return max(kinds, default="")
    for kind, *values in _ATTRIBUTE.findall(attributes):
        kind, named = kind.lower(), "".join(values)
        value = named.lower()
        if kind == "hidden" or kind == "aria-hidden" and value == "true" or kind == "style" and _HIDDEN.search(value):
            kinds.add("sure")
        if kind == "role" and value.strip() in FURNITURE_ROLES:
            kinds.add("named" if value.strip() == "form" else "sure")
        # An article stays one, whatever it is called.
        if kind in ("class", "id") and name not in MAIN:
            names = _names(named, whole)
            if "hidden" in names:
                kinds.add("sure")
            elif names:
                kinds.add("replies" if names & REPLIES else "named")
    return max(kinds, default="")  # "sure" goes before "replies", and that before "named"


class Line(NamedTuple):
    text: str
    own: int  # the length outside links
    main: bool
    inside: tuple[int, ...] = ()  # the numbers of the element around the line, and of that around a line without a block of its own


class _Skipped:
    """An element left out by its name: where it starts, its text outside links, and whether it has an article or main.

    ``within`` has those inside it that hold all of its text and are of its kind, from outside in.
    """

    def __init__(self, at: int, kind: str):
        self.at, self.kind, self.held, self.has_main = at, kind, 0, False
        self.mains = 0
        self.named: list[list] = []  # [at, kind, held and mains in front of it, then in it]

    def within(self) -> list[int]:
        found = []
        for at, kind, held, mains in self.named:
            if held != self.held or kind != self.kind or bool(mains) != self.has_main:
                break
            found.append(at)
        return found


class _Stack:
    """The open elements, with the places of each name and kind, so that no question goes over the stack."""

    def __init__(self):
        self.names: list[str] = []
        self.numbers: list[int] = []
        self.opened = 0
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.parts: list[int] = []
        self.around: list[int] = []  # blocks that are no parts, and not the page itself

    def __len__(self) -> int:
        return len(self.names)

    def _lists(self, name: str) -> list[list[int]]:
        lists = [self.places.setdefault(name, [])]
        if name in BLOCK:
            lists.append(self.blocks)
        if name in PARTS:
            lists.append(self.parts)
        elif name in BLOCK and name not in ("html", "body"):
            lists.append(self.around)
        return lists

    def push(self, name: str) -> None:
        for places in self._lists(name):
            places.append(len(self.names))
        self.opened += 1
        self.names.append(name)
        self.numbers.append(self.opened)

    def cut(self, depth: int) -> None:
        while len(self.names) > depth:
            self.numbers.pop()
            for places in self._lists(self.names.pop()):
                places.pop()

    def last(self, name: str) -> int:
        """The place of the innermost element of a name, or -1."""
        places = self.places.get(name)
        return places[-1] if places else -1

    def block_from(self, depth: int) -> bool:
        return bool(self.blocks) and self.blocks[-1] >= depth

    def inside(self) -> tuple[int, ...]:
        """The number of the element around what stands here, and of that around it if this is its own text; 0 is the page."""
        own = bool(self.around) and not (self.parts and self.parts[-1] > self.around[-1])
        numbers = tuple(self.numbers[i] for i in self.around[-1 - own :][::-1])
        return numbers + ((0,) if len(self.around) < 1 + own else ())


def lines_of(html: str) -> list[Line]:
    """The lines of a page; furniture leaves empty lines.

    An element that only its name makes furniture stays if it turns out to wrap the text of the page. The page is
    read once more for each such element that has text of its own.
    """
    spared: set[int] = set()
    while True:
        lines, skipped = _lines(html, spared)
        wrapper = _wrapper(lines, skipped)
        if wrapper is None:
            return lines
        spared.update([wrapper.at, *wrapper.within()])


def _wrapper(lines: list[Line], skipped: list[_Skipped]) -> _Skipped | None:
    """The skipped element that holds the text of the page, if one does."""
    if not any(s.held for s in skipped) or any(line.text and line.main for line in lines):
        return None
    own = [line.own for line in lines]
    rest = max((sum(own[i : i + WINDOW]) for i in range(len(own))), default=0)
    total = sum(own) + sum(s.held for s in skipped)

    def wraps(s: _Skipped) -> bool:
        most = 2 * s.held > total
        if rest < SURGE and s.held and (most or s.has_main):
            return True
        return s.kind != "replies" and 4 * s.held >= 3 * total

    return max(filter(wraps, skipped), key=lambda s: (s.has_main, s.held), default=None)


def _lines(html: str, spared: set[int]) -> tuple[list[Line], list[_Skipped]]:
    lines: list[Line] = []
    parts: list[str] = []
    linked = 0
    stack = _Stack()
    main_depth = skip_depth = link_depth = None  # the place in the stack of the outermost such element
    lower: str | None = None
    skipped: list[_Skipped] = []
    named: _Skipped | None = None  # the element being skipped, if only by its name
    sure_depth = None  # the place of sure furniture inside it
    inner: list[tuple[int, list]] = []  # places and records of the open ones inside it
    last_end = html.rfind(">")

    def end_line() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                lines.append(Line(text, max(0, len(text) - linked), main_depth is not None, stack.inside()))
            parts, linked = [], 0

    def settle(depth: int) -> None:
        while inner and depth <= inner[-1][0]:
            _, record = inner.pop()
            record[2:] = named.held - record[2], named.mains - record[3]

    def close_to(depth: int) -> None:
        nonlocal main_depth, skip_depth, link_depth, named, sure_depth
        if skip_depth is None and stack.block_from(depth):
            end_line()
        stack.cut(depth)
        settle(depth)
        if skip_depth is not None and depth <= skip_depth:
            skip_depth = named = None
            lines.extend([Line("", 0, main_depth is not None and depth > main_depth)] * WINDOW)
        if sure_depth is not None and depth <= sure_depth:
            sure_depth = None
        if link_depth is not None and depth <= link_depth:
            link_depth = None
        if main_depth is not None and depth <= main_depth:
            main_depth = None

    def add(text: str) -> None:
        nonlocal linked
        if text and skip_depth is None:
            parts.append(text)
            if link_depth is not None:
                linked += len(text.strip())
        elif named is not None and sure_depth is None and link_depth is None:
            named.held += len(text.strip())

    at = 0
    while True:
        tag = _TAG.search(html, at)
        if tag is None:
            add(html[at:])
            break
        add(html[at : tag.start()])
        at = tag.end()
        if tag[0] == "<!--":
            end = html.find("-->", at)
            at = len(html) if end < 0 else end + 3
            continue
        if tag[2] is None:
            if at > last_end:
                add(tag[0])
            else:
                at = html.find(">", at) + 1
            continue
        name = tag[2].lower()
        if tag[1]:
            if stack.last(name) >= 0:
                close_to(stack.last(name))
            elif name in BLOCK and skip_depth is None:
                end_line()
            continue
        if name in RAW:
            lower = html.lower() if lower is None else lower
            if len(lower) != len(html):  # a few characters change their number in lower case
                lower = re.sub("[A-Z]+", lambda m: m[0].lower(), html)
            end = lower.find(f"</{name}", at)
            at = len(html) if end < 0 else end
            tail = html.find(">", at)
            at = len(html) if tail < 0 else tail + 1
            continue
        if name == "br" or name in ("td", "th"):
            add(" ")
        if name in BLOCK:
            depth = stack.last("p")
            if depth >= 0 and name not in ("body", "html") and not stack.block_from(depth + 1):
                # A block ends an open paragraph.
                close_to(depth)
            if name == "li" and stack.names[-1:] == ["li"]:
                close_to(len(stack) - 1)
            if skip_depth is None:
                end_line()
        if name in VOID or tag[3].endswith("/") and name not in BLOCK:
            continue
        stack.push(name)
        kind = ""
        if skip_depth is None or named is not None and sure_depth is None:
            kind = _furniture(name, tag[3], main_depth is not None)
        if skip_depth is None:
            if kind and (kind == "sure" or tag.start() not in spared):
                end_line()
                skip_depth = len(stack) - 1
                if kind != "sure":
                    named = _Skipped(tag.start(), kind)
                    skipped.append(named)
            elif name in MAIN and main_depth is None:
                main_depth = len(stack) - 1
        elif named is not None and sure_depth is None:
            if kind == "sure":
                sure_depth = len(stack) - 1
            elif name in MAIN:
                named.has_main = True
                named.mains += 1
            elif kind:
                record = [tag.start(), kind, named.held, named.mains]
                named.named.append(record)
                inner.append((len(stack) - 1, record))
        if name == "a" and link_depth is None:
            link_depth = len(stack) - 1
    end_line()
    settle(0)
    return lines, skipped


def main_text(html: str | None) -> str:
    """The lines between surge and dive points, and others of the same elements, joined by line ends; empty if there are none."""
    lines = lines_of(html or "")
    has_main = any(line.text and line.main for line in lines)
    if has_main:
        lengths = [len(line.text) if line.main else 0 for line in lines]
    else:
        lengths = [line.own for line in lines]
    surge = SURGE_MAIN if has_main else SURGE
    sums = [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]
    regions, start, peak = [], None, 0
    for i, total in enumerate([*sums, 0]):
        if total and start is None:
            start, peak = i, 0
        if start is not None:
            peak = max(peak, total)
            if not total:  # dive: nothing in the window from here on
                regions.append((peak, start, i))
                start = None
    kept = [r for r in regions if r[0] >= surge] or sorted(regions, key=lambda r: (-r[0], r[1]))[:1]
    # Furniture inside an element parts its text: what stands in the same one goes with a region that is kept.
    around = {number for _, low, high in kept for i in range(low, high) if lengths[i] for number in lines[i].inside}
    chosen = set(kept)
    kept = [r for r in regions if r in chosen or any(around.intersection(lines[i].inside) for i in range(r[1], r[2]) if lengths[i])]
    found = []
    for _, low, high in kept:
        # The first windows reach ahead of the text they see.
        filled = [i for i in range(low, high) if lengths[i]]
        inside = range(filled[0], filled[-1] + 1)
        found += [lines[i].text for i in inside if lines[i].text and (lengths[i] or not has_main)]
    return "\n".join(found)


def extracted(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """The columns of ``pages`` without the html, and ``text``, for each row; null html is empty."""
    names = [c for c in pages.columns if c not in (html, "text")]
    columns = pages.select(*names, F.col(html).cast("string").alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py()) for x in batch.column(len(names))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], texts], [*names, "text"])

    return columns.mapInArrow(run, columns.select(*names, F.lit("").alias("text")).schema)
