"""Main text of web pages by line-block distribution.

Markup is stripped first, in one pass over the page with the states of HTML for names, attributes and their values.
Comments, scripts, styles and elements that are menus, headers, footers or sidebars by their tag, role or state go
with their content. Forms, and elements whose class or id has a part that names menus, notices, adverts or reader
comments, are doubtful: they stay if they hold the page's first article or main. Else the windows below decide: where
the lines outside them surge, these are the main text and doubtful elements go. Where they don't, a doubtful
element stays if there is nothing else but headings, and one that is doubtful by its layout (a form, a sidebar) if it
has ``WHOLE`` times the text of the rest. Articles and mains never go by a name, but comments that are articles
within one do. Elements end where HTML lets an end tag be left out, or with an element around them;
every block element begins a new line. The weight of a line is its length outside links. In an ``article`` or
``main`` element it is raised by up to ``RAISED``, times the share of the page's text outside links that lies
in such elements and the share of the line that lies outside links; lines outside weigh what they hold.
Weights are summed over windows of ``WINDOW`` lines. Text begins where the sum surges to ``SURGE``, in an
article with the lines before that are no dive, and ends where it dives below ``DIVE``, unless only lines with text
outside links and of the same container follow up to the next surge; short paragraphs next to it in the same container,
if that isn't the page's body, belong to it. Of these lines those with a weight are kept, in an article also
paragraphs of links between two such, and headings right before them. A page that never surges keeps
all its lines with a weight, and in an article lines of links that aren't lists.

One scan, a page at a time, no shuffle; a page's cost is linear in its length, however its markup is broken.

Defined cases: null and empty pages have an empty text; a tag, comment or script that is never closed ends with the
page, elements that are never closed too, except that content dropped before the first article ends where that
begins; repeated pages give repeated rows; an empty table gives an empty result; other columns are left out.
A page of any length is held as a whole by its task, some ten times its bytes.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import named
from tidemark.llm.common import small_batches

WINDOW = 3
SURGE = 80
DIVE = 25
#: The most that a line in an article or main is raised by: less than a surge, more than a dive.
RAISED = 30
#: How many times the text of the rest makes an element the main text that is doubtful by its layout.
WHOLE = 4

TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
#: The rest of a usual tag: values in quotes that hold no angle brackets, and no others.
USUAL = re.compile(r"((?:\s++[a-zA-Z][\w:.-]*+(?:=\"[^\"<>]*+\")?+)*+)\s*+(/?+)>")
ATTRIBUTE = re.compile(r"([\w:.-]++)(?:=\"([^\"]*+)\")?+")
BETWEEN = re.compile(r"[\s/]*+")
NAME = re.compile(r"=?+[^\s/>=]*+")
EQUALS = re.compile(r"\s*+=\s*+")
UNQUOTED = re.compile(r"[^\s>]++")
COMMENT_END = re.compile(r"--!?>")
#: Elements whose content is no markup.
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp")}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
REGIONS = {"article", "main"}
#: Elements whose lines belong together, and those of the whole page.
CONTAINERS = set("article aside center details div fieldset footer form header main section td".split())
LISTS = set("li dd dt td th".split())
DROPPED = set(
    "nav footer aside form button dialog menu canvas audio video map head noscript template svg select object".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search alert dialog form menu menubar".split())
#: Parts of names: of what is no main text whatever its size, of reader comments, and of places on a page.
KINDS = set(
    "ad ads adsense advert adverts advertisement advertising breadcrumb breadcrumbs consent cookie cookies copyright"
    " footer gdpr login masthead menu nav navbar navigation newsletter notice notification pagination promo"
    " promotion related share sharing signup skip social sponsor sponsored subscribe".split()
)
READERS = set("comment comments disqus replies".split())
PLACES = set("banner modal popup sidebar toolbar".split())
#: Names that only count as a whole.
WHOLE_NAMES = set("widget widget-area side-bar nav-bar sidebar-widget".split())
#: What makes a name say that something is near, absent or in some state instead.
BEFORE = set("has no non not with without hide hidden is category tag type status format topic author".split())
AFTER = set("open closed enabled disabled on off allowed count none free less".split())
TABLE = set("table caption tbody tfoot thead tr td th".split())
#: Starts that do not end a paragraph, starts that end an open one of the names, and what may stand in a head.
NOT_AFTER_P = TABLE - {"table"} | {"body", "legend"}
SIBLINGS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}}
ROWS = dict.fromkeys(("td", "th"), {"td", "th"}) | {"tr": {"td", "th", "tr", "caption"}}
ROWS |= dict.fromkeys(("tbody", "tfoot", "thead"), TABLE - {"table"})
IN_HEAD = set("html head base basefont bgsound link meta noscript template".split())
SPLIT_NAMES = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z])(?=[A-Z])")


def rest_of_tag(html: str, at: int) -> tuple[int, dict[str, str] | None, bool]:
    """Where a tag ends whose name ends at ``at``, its attributes and whether it closes itself; no
    attributes are given where the page ends before the tag."""
    if usual := USUAL.match(html, at):
        found = {}
        for m in ATTRIBUTE.finditer(usual[1]):
            found.setdefault(m[1].lower(), m[2] or "")
        return usual.end(), found, bool(usual[2])
    found, n = {}, len(html)
    while True:
        gap = BETWEEN.match(html, at)
        at = gap.end()
        if at >= n:
            return n, None, False
        if html[at] == ">":
            return at + 1, {k: unescape(v) for k, v in found.items()}, gap[0].endswith("/")
        name = NAME.match(html, at)
        at, value = name.end(), ""
        if equals := EQUALS.match(html, at):
            at = equals.end()
            if at >= n:
                return n, None, False
            if (quote := html[at]) in "\"'":
                end = html.find(quote, at + 1)
                if end < 0:
                    return n, None, False
                value, at = html[at + 1 : end], end + 1
            elif quote != ">":
                unquoted = UNQUOTED.match(html, at)
                value, at = unquoted[0], unquoted.end()
        found.setdefault(name[0].lower(), value)


def tokens(html: str) -> Iterator[tuple[str, str, dict[str, str] | None, bool]]:
    """The page's texts (``text``, itself) and tags (``open`` or ``close``, name, attributes, closes itself) in order,
    without comments and without the content of raw elements."""
    at, n = 0, len(html)
    while at < n:
        if html[at] != "<":
            end = html.find("<", at)
            end = n if end < 0 else end
            yield "text", html[at:end], None, False
            at = end
            continue
        closing = html.startswith("</", at)
        if name := TAG_NAME.match(html, at + 1 + closing):
            at, found, closes = rest_of_tag(html, name.end())
            if found is None:
                return
            tag = name[0].lower()
            yield "close" if closing else "open", tag, found, closes
            if tag in RAW and not closing:
                end = RAW[tag].search(html, at)
                at = end.start() if end else n
        elif html.startswith("<!--", at):
            if html.startswith((">", "->"), at + 4):
                at = html.index(">", at + 4) + 1
            else:
                end = COMMENT_END.search(html, at + 4)
                at = end.end() if end else n
        elif closing or html.startswith(("<!", "<?"), at):
            if closing and at + 2 >= n:
                yield "text", "</", None, False
            end = html.find(">", at)
            at = n if end < 0 else end + 1
        else:
            yield "text", "<", None, False
            at += 1


@lru_cache(maxsize=4096)
def doubt(names: str) -> str:
    """What class names and ids say an element is: ``reader``, ``kind``, ``place``, or nothing."""
    found = set()
    for name in names.split():
        parts = [p.lower() for p in SPLIT_NAMES.split(name) if p]
        if not parts or (len(parts) > 1 and (parts[0] in BEFORE or parts[-1] in AFTER)):
            continue
        if not READERS.isdisjoint(parts):
            found.add("reader")
        elif not KINDS.isdisjoint(parts):
            found.add("kind")
        elif not PLACES.isdisjoint(parts) or "-".join(parts) in WHOLE_NAMES:
            found.add("place")
    return next((x for x in ("reader", "kind", "place") if x in found), "")


def judged(tag: str, found: dict[str, str], in_region: bool) -> str:
    """``out`` for an element that is no part of the main text by its tag, role or state, else what it is doubtful
    by. An article or main is never judged by its name, unless it is a comment within one."""
    if (tag in DROPPED and tag != "form") or (tag == "header" and not in_region):
        return "out"
    if tag in ("html", "body"):
        return ""
    doubtful = "place" if tag == "form" else ""
    if not found:
        return doubtful
    if "hidden" in found or found.get("aria-hidden") == "true":
        return "out"
    if re.search(r"display\s*:\s*none", found.get("style", "")) or found.get("role", "").lower() in DROPPED_ROLES:
        return "out"
    kind = doubt(found.get("class", "") + " " + found.get("id", ""))
    if tag in REGIONS:
        return kind if kind == "reader" and tag == "article" and in_region else ""
    return kind or doubtful


class Line:
    __slots__ = ("parts", "linked", "own", "tag", "region", "named", "place")

    def __init__(self, tag: str, region: bool):
        self.own = False  # whether there is text outside links
        self.parts, self.linked, self.tag, self.region, self.named, self.place = [], 0, tag, region, -1, 0


class Open:
    """The elements that are open. Where HTML lets an end tag be left out, the start that implies it
    closes the element; an end tag closes what was begun within its element."""

    def __init__(self):
        self.tags: list[str] = []
        self.at: dict[str, list[int]] = defaultdict(list)
        self.solid, self.walls, self.cells = [], [], []
        #: Where containers stand, and a number of each.
        self.containers, self.numbers, self.n = [], [0], 0

    def push(self, tag: str) -> None:
        n = len(self.tags)
        self.tags.append(tag)
        self.at["h" if tag in HEADINGS else tag].append(n)
        if tag in BLOCKS or tag in DROPPED:
            self.solid.append(n)
            if tag not in ("address", "div", "p"):
                self.walls.append(n)
        if tag in TABLE:
            self.cells.append(n)
        if tag in CONTAINERS:
            self.n += 1
            self.containers.append(n)
            self.numbers.append(self.n)

    def cut(self, n: int) -> None:
        """Close all but the first n."""
        while len(self.tags) > n:
            tag = self.tags.pop()
            self.at["h" if tag in HEADINGS else tag].pop()
        for places in (self.solid, self.walls, self.cells):
            while places and places[-1] >= n:
                places.pop()
        while self.containers and self.containers[-1] >= n:
            self.containers.pop()
            self.numbers.pop()

    def imply(self, tag: str) -> None:
        """Close what the start of an element ends."""
        at = self.at
        if "head" in at and at["head"] and tag not in IN_HEAD:
            self.cut(at["head"][-1])
        if tag in BLOCKS and tag not in NOT_AFTER_P and at["p"] and not (at["button"] and at["button"][-1] > at["p"][-1]):
            self.cut(at["p"][-1])
        if tag in SIBLINGS and self.walls and self.tags[self.walls[-1]] in SIBLINGS[tag]:
            self.cut(self.walls[-1])
        while tag in ROWS and self.cells and self.tags[self.cells[-1]] in ROWS[tag]:
            self.cut(self.cells[-1])
        if tag in HEADINGS and self.tags and self.tags[-1] in HEADINGS:
            self.cut(len(self.tags) - 1)

    def close(self, tag: str) -> None:
        """Close the innermost element of the name; an inline one only up to the block around."""
        places = self.at["h" if tag in HEADINGS else tag]
        if places and (tag in BLOCKS or tag in DROPPED or not self.solid or places[-1] >= self.solid[-1]):
            self.cut(places[-1])


def lines(html: str) -> list[tuple[str, int, str, bool, int]]:
    """Text, length outside links, tag, whether in an article, and container of each line with text."""
    out: list[Line] = [Line("", False)]
    stack, drop, links, seen = Open(), None, 0, set()
    regions: list[int] = []
    named_at: list[int] = []
    #: Of each doubtful element: the one around it, why, and whether it holds the first article or main.
    around, kinds, holds = [], [], []
    inside: list[int] = []
    readers = 0

    def begin(tag: str) -> None:
        if out[-1].parts:
            out.append(Line(tag, bool(regions)))
        out[-1].tag, out[-1].region, out[-1].named = tag, bool(regions), inside[-1] if inside else -1
        out[-1].place = stack.numbers[-1]

    def settle() -> None:
        """Forget what is closed."""
        nonlocal drop, readers
        n, ended = len(stack.tags), False
        if drop is not None and drop >= n:
            drop, ended = None, True
        while named_at and named_at[-1] >= n:
            named_at.pop()
            readers -= kinds[inside.pop()] == "reader"
            ended = True
        while regions and regions[-1] >= n:
            regions.pop()
            ended = True
        if ended:
            begin(out[-1].tag)

    for what, tag, found, closes in tokens(html):
        if what == "text":
            if drop is not None and stack.tags[drop] == "head" and tag.strip():
                stack.cut(drop)
                settle()
            if drop is None:
                text = unescape(tag)
                out[-1].parts.append(text)
                if links:
                    out[-1].linked += len(text.strip())
                elif not out[-1].own:
                    out[-1].own = not text.isspace()
            continue
        closing = what == "close"
        if tag in RAW:
            continue
        if closing:
            stack.close(tag)
        else:
            stack.imply(tag)
        settle()
        if not closing and tag not in VOID:
            kind = judged(tag, found, bool(regions))
            region = tag in REGIONS and not kind and not readers
            if region and not seen:
                drop = None
            if drop is None and kind and closes:
                continue
            if drop is None and kind == "out":
                drop = len(stack.tags)
                if tag in BLOCKS:
                    begin("")
            elif drop is None and kind:
                around.append(inside[-1] if inside else -1)
                kinds.append(kind)
                holds.append(False)
                named_at.append(len(stack.tags))
                inside.append(len(holds) - 1)
                readers += kind == "reader"
                begin(out[-1].tag)
            if drop is None and region:
                regions.append(len(stack.tags))
                if tag not in seen:
                    seen.add(tag)
                    for k in inside:
                        holds[k] = True
            if kind or tag in BLOCKS or tag in DROPPED or tag == "html" or stack.at.get(tag):
                stack.push(tag)
        if drop is not None:
            continue
        if tag == "a":
            links = 0 if closing else 1
        if tag == "br":
            out[-1].parts.append(" ")
        if tag in BLOCKS:
            links = 0
            begin("" if closing else tag)
    texts, names = [], []
    for line in out:
        text = " ".join("".join(line.parts).split())
        if text:
            texts.append((text, max(0, len(text) - line.linked) if line.own else 0, line.tag, line.region, line.place))
            names.append(line.named)
    keep = kept_names(texts, names, around, kinds, holds)
    return [line for line, k in zip(texts, names, strict=True) if k < 0 or keep[k]]


def kept_names(
    texts: list[tuple[str, int, str, bool, int]], names: list[int], around: list[int], kinds: list[str], holds: list[bool]
) -> list[bool]:
    """Which of the doubtful elements stay, ``names`` being the innermost one of each line. There are a few rounds at
    most: the first with text lets in all that have ``WHOLE`` times as much, and what waits then has less."""
    within, direct = [0] * len(holds), [False] * len(holds)
    for (_, size, tag, *_), k in zip(texts, names, strict=True):
        if k >= 0:
            within[k] += size
            direct[k] = direct[k] or bool(size and tag not in HEADINGS)
    children = defaultdict(list)
    for k in range(len(holds) - 1, -1, -1):
        children[around[k]].append(k)
        if around[k] >= 0:
            within[around[k]] += within[k]
    keep = [False] * len(holds)
    wanted, waiting = [-1], []

    def let_in(first: list[int], passes) -> None:
        """Keep elements, and those within them that pass; the rest waits."""
        while first:
            for k in children[first.pop()]:
                if passes(k):
                    keep[k] = True
                    first.append(k)
                else:
                    waiting.append(k)

    let_in(wanted, lambda k: holds[k])
    while waiting:
        visible = [line for line, k in zip(texts, names, strict=True) if k < 0 or keep[k]]
        if any(x >= SURGE for x in sums_of(weights_of(visible))):
            break
        rest = sum(size for _, size, tag, *_ in visible if tag not in HEADINGS)
        is_most = lambda k: kinds[k] == "place" and within[k] > WHOLE * rest  # noqa: B023, E731
        first = [k for k in waiting if not rest or is_most(k)]
        if not first:
            break
        chosen = set(first)
        waiting = [k for k in waiting if k not in chosen]
        for k in first:
            keep[k] = True
        # Without any text so far, what is within an element that has none of its own comes with it.
        let_in(first, lambda k: holds[k] or (is_most(k) if rest else not direct[around[k]]))
    return keep


def weights_of(found: list[tuple[str, int, str, bool, int]]) -> list[float]:
    total = sum(line[1] for line in found)
    raised = RAISED * sum(line[1] for line in found if line[3]) / max(1, total)
    return [size + (raised * size / len(text) if region else 0) for text, size, _, region, _ in found]


def sums_of(weights: list[float]) -> list[float]:
    half = WINDOW // 2
    return [sum(weights[max(0, i - half) : i + half + 1]) for i in range(len(weights))]


def main_lines(found: list[tuple[str, int, str, bool, int]]) -> list[str]:
    """The lines between surge and dive points."""
    weights = weights_of(found)
    sums, n = sums_of(weights), len(found)
    runs, begin = [], None
    for i, surging in enumerate(sums):
        if begin is None and surging >= SURGE:
            begin = i
            while begin and found[begin - 1][3] and sums[begin - 1] >= DIVE and (not runs or begin > runs[-1][1]):
                begin -= 1
        elif begin is not None and surging < DIVE:
            runs.append((begin, i))
            begin = None
    if begin is not None:
        runs.append((begin, n))

    def belongs(i: int, to: int) -> bool:
        """Whether a line with text of its own stands in the container of another one."""
        return bool(weights[i]) and found[i][4] == found[to][4]

    joined: list[tuple[int, int]] = []
    for a, b in runs:
        if joined and found[joined[-1][1] - 1][4] == found[a][4] and all(belongs(i, a) for i in range(joined[-1][1], a)):
            joined[-1] = (joined[-1][0], b)
            continue
        # Short paragraphs on either side, in a container of their own.
        while found[a][4] and a > (joined[-1][1] if joined else 0) and belongs(a - 1, a) and found[a - 1][2] == "p":
            a -= 1
        joined.append((a, b))
    runs = []
    for k, (a, b) in enumerate(joined):
        end = joined[k + 1][0] if k + 1 < len(joined) else n
        while found[b - 1][4] and b < end and belongs(b, b - 1) and found[b][2] == "p":
            b += 1
        runs.append((a, b))
    kept = {i for a, b in runs for i in range(a, b) if weights[i]}
    for a, b in runs:
        weighty = [i for i in range(a, b) if weights[i]]
        for i in range(weighty[0], weighty[-1]) if weighty else ():
            lone = i > a and weights[i - 1] and weights[i + 1]
            if found[i][3] and not weights[i] and (lone or found[i][2] == "p"):
                kept.add(i)
    if not runs:
        kept = {i for i, line in enumerate(found) if weights[i] or (line[3] and line[2] not in LISTS)}
    for i in range(n - 2, -1, -1):
        if found[i][2] in HEADINGS and (weights[i] or found[i][3]) and i + 1 in kept:
            kept.add(i)
    return [found[i][0] for i in sorted(kept)]


def main_text(html: str | None) -> str:
    return "\n".join(main_lines(lines(html))) if html else ""


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html", 1 << 22):
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), named(html).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
