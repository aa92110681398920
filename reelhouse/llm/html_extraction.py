"""Main text of web pages as the maximum-scoring subsequence of their tokens.

A page is a sequence of text runs and tags. The words of a run score positive, by how often words
in such a place are content on labelled pages; a tag scores negative, by how seldom it stands inside
content there. One linear scan finds the contiguous region with the highest sum. Elements inside
the region that never hold main text are left out of it.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_ROWS = 256
#: Elements whose content is no markup.
RAW = set("script style noscript template textarea title iframe svg".split())
OPENING = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: A raw element's name may also end at a mark that other names hold.
RAW_NAME = re.compile(rf"<({'|'.join(sorted(RAW))})\b", re.IGNORECASE)
RAW_END = {name: re.compile(rf"</{name}\s*+>", re.IGNORECASE) for name in RAW}
QUOTE_OR_END = re.compile(r"[>\"']")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORDS = re.compile(r"[^\W_]+")
LABEL = re.compile(r"<article[\s>]", re.IGNORECASE)

# Elements by role, and names that mark an element as no main text.
CONTAINERS = set("article main section div aside nav header footer form ul ol table body".split())
BLOCKS = CONTAINERS | set(
    "p h1 h2 h3 h4 h5 h6 li dl dt dd blockquote pre figure figcaption address hr"
    " thead tbody tfoot tr td th caption fieldset details summary html head".split()
)
ARTICLES = ("article", "main")
NEVER = set("nav footer aside form head button select dialog menu".split())
RUNNING = tuple("p h1 h2 h3 h4 h5 h6 blockquote b i em strong span br sup sub code q".split())
VOID = set("br hr img input meta link area base col embed source track wbr".split())
NEVER_NAMES = set(
    "ad ads advert adverts advertisement sponsor sponsored promo banner sidebar menu nav navbar"
    " navigation breadcrumb breadcrumbs cookie cookies consent notice popup modal comment comments"
    " disqus reply replies share sharing social related newsletter subscribe footer masthead widget"
    " toolbar pagination contentinfo complementary".split()
)
#: Words of readers, which may well be most of a page.
REPLIES = set("comment comments disqus reply replies".split())
#: ``has-sidebar`` and ``no-comments`` tell of an element beside or inside this one.
STATES = set("has have no not with without hide show is".split())


def never_names(named: str) -> set[str]:
    """Names of NEVER_NAMES that a lower-case class, id or role has whole or as its last word."""
    found = set()
    for name in named.split():
        words = [w for w in WORDS.findall(name) if not w.isdigit()]
        if words and words[-1] in NEVER_NAMES and words[0] not in STATES:
            found.add(words[-1])
    return found


@dataclass(slots=True)
class Token:
    """A comment, raw element or tag from ``start`` to ``stop``; only a tag has a ``tag``."""

    start: int
    stop: int
    raw: str = ""
    tag: str = ""
    end: bool = False
    rest: str = ""


class TagEnds:
    """Finds the ``>`` of tags outside quotes, in time linear in the page for all tags together.

    What follows a place outside quotes is the same for whichever tag got there, so it is kept for
    each quote or ``>`` met. A quote that is never closed leaves a tag without an end.
    """

    def __init__(self, page: str):
        self.page = page
        self.first = (0, -1)  # the first mark at or after every place of this span
        self.known: dict[int, int] = {}

    def _first_mark(self, at: int) -> int:
        begin, mark = self.first
        if not begin <= at <= mark:
            found = QUOTE_OR_END.search(self.page, at)
            mark = found.start() if found else len(self.page)
            self.first = (at, mark)
        return mark

    def after(self, at: int) -> int:
        """The place of the tag's ``>`` from ``at`` on, or -1."""
        page, met = self.page, []
        mark, out = self._first_mark(at), -1
        while mark < len(page):
            if mark in self.known:
                out = self.known[mark]
                break
            met.append(mark)
            if page[mark] == ">":
                out = mark
                break
            close = page.find(page[mark], mark + 1)
            if close < 0:
                break
            found = QUOTE_OR_END.search(page, close + 1)
            mark = found.start() if found else len(page)
        if len(met) > 1 or out < 0:
            self.known.update(dict.fromkeys(met, out))
        return out


def tokens(page: str) -> Iterator[Token]:
    """Comments, raw elements and tags in page order; what is between them is text."""
    ends, at, size = TagEnds(page), 0, len(page)
    last_end = page.rfind(">")
    while (start := page.find("<", at)) >= 0:
        token = None
        if page.startswith("<!--", start):
            stop = page.find("-->", start + 4)
            token = Token(start, size if stop < 0 else stop + 3)
        elif start < last_end and (raw := RAW_NAME.match(page, start)):
            name = raw[1].lower()
            close = RAW_END[name].search(page, page.find(">", raw.end()) + 1)
            token = Token(start, close.end() if close else size, raw=name)
        elif start < last_end and (opening := OPENING.match(page, start)):
            stop = ends.after(opening.end())
            if stop >= 0:
                rest = page[opening.end() : stop]
                token = Token(start, stop + 1, "", opening[2].lower(), bool(opening[1]), rest)
        if token is None and page[start + 1 : start + 2] in ("!", "?", "/"):
            stop = page.find(">", start + 2) if start < last_end else -1
            token = Token(start, size if stop < 0 else stop + 1)
        at = token.stop if token else start + 1
        if token:
            yield token


@dataclass(frozen=True)
class Run:
    """Words with their place, or a tag.

    ``never``: in an element that holds no main text; ``inside``: in an element that labels it.
    """

    words: list[str]
    place: str
    block: str
    never: bool
    breaks: bool
    inside: bool


def page_runs(page: str, labels: tuple[str, ...] = ARTICLES) -> list[Run]:
    """The page as runs in order, ``inside`` those elements. Unclosed and stray tags are put up with.

    Every step takes a time that does not grow with the page or with how deep elements are nested.
    """
    runs: list[Run] = []
    # Container, its key, whether its tag or one around it rules main text out, its names that do, its first run.
    open_: list[tuple[str, str, bool, set[str], int]] = []
    spans: list[tuple[str, int, int, set[str]]] = []  # tag, first run, end and names of closed ones
    within: Counter = Counter()  # open elements by tag
    block, last = "", 0

    def text(chunk: str) -> None:
        words = html.unescape(chunk).split() if chunk else []
        if words:
            spaced = chunk[:1].isspace(), chunk[-1:].isspace()
            words = [("" if i or not spaced[0] else " ") + w for i, w in enumerate(words)]
            words[-1] += " " if spaced[1] else ""
            runs.append(Run(words, place(), block, never(), False, marked()))
        elif chunk:
            runs.append(Run([" "], place(), block, never(), False, marked()))

    place = lambda: open_[-1][1] if open_ else ""
    never = lambda: bool(open_) and open_[-1][2]
    marked = lambda: any(within[tag] for tag in labels)

    def close(end: int) -> tuple[str, str, bool, set[str], int]:
        """Take the innermost element off."""
        element = open_.pop()
        tag, _, bad, names, first = element
        within[tag] -= 1
        if not bad and (names or tag in ARTICLES):
            spans.append((tag, first, end, names))
        return element

    for found in tokens(page):
        text(page[last : found.start])
        last = found.stop
        tag = found.tag
        if not tag:
            if found.raw:
                runs.append(Run([], found.raw, block, True, False, marked()))
            continue
        key, shut = tag, False
        if not found.end:
            named = " ".join("".join(m) for m in NAMES.findall(found.rest)).lower()
            names = WORDS.findall(named)
            key = ".".join([tag, *names[:2]])
            if tag in CONTAINERS or tag in NEVER:
                bad = tag in NEVER or tag == "header" and not any(within[a] for a in ARTICLES)
                if tag not in VOID and not found.rest.rstrip().endswith("/"):
                    out = never_names(named) if tag != "body" else set()
                    open_.append((tag, key, never() or bad, out, len(runs)))
                    within[tag] += 1
        elif within[tag]:
            # Elements left open inside it end here as well.
            while open_[-1][0] != tag:
                close(len(runs))
            _, key, shut, *_ = close(len(runs) + 1)
        if tag in BLOCKS:
            block = "" if found.end else tag
        runs.append(Run([], key, block, never() or shut, tag in BLOCKS or tag == "br", marked()))
        if tag == "br":
            runs[-1] = Run([" "], place(), block, never(), False, marked())
    text(page[last:])
    while open_:
        close(len(runs))
    return _without_named(runs, spans) if any(names for *_, names in spans) else runs


def _without_named(runs: list[Run], spans: list[tuple[str, int, int, set[str]]]) -> list[Run]:
    """``runs`` with ``never`` set in the spans (tag, first run, end, names) that their names rule out.

    Names do not rule out what holds the page's longest article or main element. On a page with
    neither they do not rule out what holds most of its words either, but for those of readers.
    """
    words = [0]
    for run in runs:
        words.append(words[-1] + (0 if run.never else sum(1 for w in run.words if w != " ")))
    held = lambda span: words[span[2]] - words[span[1]]
    mains = [s for s in spans if s[0] in ARTICLES and not REPLIES & s[3] and held(s)]
    # The first and outermost of equals.
    longest = max(mains, key=lambda s: (held(s), -s[1]), default=None)
    # Where the spans that rule out begin and end; between, at least one is open.
    change = [0] * (len(runs) + 1)
    for span in spans:
        _, first, end, names = span
        if longest:
            kept = first <= longest[1] and longest[2] <= end
        else:
            kept = 2 * held(span) > words[-1] and not REPLIES & names
        if names and not kept:
            change[first] += 1
            change[min(end, len(runs))] -= 1
    ruled_out = accumulate(change)
    return [replace(r, never=True) if out and not r.never else r for r, out in zip(runs, ruled_out)]


@dataclass
class Weights:
    """Scores of a word by place or block, and of a tag; learned from labelled pages.

    Tags of running text start out nearly free, so that a page is read without any labelled one.
    """

    place: dict[str, float] = field(default_factory=dict)
    block: dict[str, float] = field(default_factory=dict)
    tag: dict[str, float] = field(default_factory=lambda: dict.fromkeys(RUNNING, -0.02))
    unseen_word: float = 0.3
    unseen_tag: float = -0.5

    def of(self, run: Run) -> float:
        # An aside or a script between two paragraphs does not part them.
        if run.never and (run.words or run.inside):
            return 0.0
        if run.words:
            each = self.place.get(run.place, self.block.get(run.block, self.unseen_word))
            return each * sum(1 for w in run.words if w != " ")
        return self.tag.get(run.place, self.unseen_tag)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous run of scores with the largest sum, the first of equals."""
    best, begin, end = 0.0, 0, 0
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, begin, end = total, start, i + 1
    return begin, end


def extract_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best region in page order, one a line; white space is one space."""
    runs = page_runs(page or "")
    begin, end = best_region([weights.of(r) for r in runs])
    blocks, now = [], []
    for run in runs[begin:end]:
        if run.breaks:
            blocks.append("".join(now))
            now = []
        elif run.words and not run.never:
            now.append(" ".join(run.words))
    blocks.append("".join(now))
    lines = [" ".join(b.split()) for b in blocks]
    return "\n".join([line for line in lines if line])


def learn_weights(pages: DataFrame, max_pages: int = 2_000) -> Weights:
    """Weights from pages that label their content themselves: by their one article element, which may
    be in a main element, or by one main element.

    At most about ``max_pages`` of these pages are used, drawn by a hash of the URL and page id at a
    rate set by the count of all of them; the tables that reach the driver are bounded by that sample.
    Null pages and pages without the label teach nothing; without any, fixed scores are used.
    """
    articles, mains = (
        F.regexp_count("html", F.lit(rf"(?i)<{tag}[\s>]")) for tag in ("article", "main")
    )
    labelled = pages.where((articles == 1) & (mains <= 1) | (articles == 0) & (mains == 1))
    total = labelled.count()
    draw = F.pmod(F.xxhash64("url", "page_id"), F.lit(max(total, 1)))
    sample = labelled.where(draw < max_pages).select("html")

    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                one = "article" if LABEL.search(page) else "main"
                for run in page_runs(page, (one,)):
                    n = sum(1 for w in run.words if w != " ")
                    if n:
                        found["place", run.place, run.inside and not run.never] += n
                        found["block", run.block, run.inside and not run.never] += n
                    elif not run.words:
                        found["tag", run.place, run.inside and not run.never] += 1
        kinds = [list(c) for c in zip(*found)] or [[], [], []]
        arrays = [pa.array(k, t) for k, t in zip(kinds, (pa.string(), pa.string(), pa.bool_()))]
        yield pa.record_batch(
            [*arrays, pa.array(list(found.values()), pa.int64())],
            names=["kind", "name", "inside", "n"],
        )

    counted = sample.mapInArrow(count, "kind string, name string, inside boolean, n long")
    totals = counted.groupBy("kind", "name").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("within"),
        F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("without"),
    )
    weights = Weights()
    for r in totals.collect():
        odds = math.log((r.within + 0.5) / (r.without + 0.5))
        if r.kind == "tag":
            weights.tag[r.name] = min(max(odds / 2, -2.0), -0.02)
        else:
            getattr(weights, r.kind)[r.name] = min(max(odds / 3, 0.01), 1.0)
    return weights


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """Every row's main text: page_id, url, text, n_chars (code points).

    A null or empty page, or one without words, has an empty text. Whole pages are read, and other
    columns are not; repeated rows stay.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    out = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]
    )

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = [extract_text(page, weights) for page in part.column(2).to_pylist()]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                columns = [part.column(0), part.column(1).cast(pa.string())]
                yield pa.record_batch([*columns, pa.array(texts, pa.string()), sizes], schema=out)

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
