"""Main text of web pages by the maximum-scoring subsequence.

A page is a row of tokens, words and tags. Words score positive, tags negative, with weights from labelled pages: those that
mark up their article. A tag costs the more, the rarer it stands inside of articles and the more often outside; what ends or
begins an article is outside of it and so is a wall, while paragraphs and headings cost next to nothing. Words inside
navigation, asides, page headers and footers, forms, adverts, notices and reader comments are tokens of their own kinds, whose
weights are negative, the more so the rarer articles hold them. A linear scan finds the contiguous region of the largest sum;
returned are its words that don't score negative. One such part takes no more from a sum than `part`, so that an advert amid an
article doesn't cut it in two. Only what is never text (scripts, styles, the page's head) has no tokens.

An element is a part of that sort by its name, or by a class, id or role all of whose words name such parts; one that wraps
the main text (an article, or most words of a page without one) isn't. Character references are decoded, white space inside a
block becomes one space, and blocks are joined by line feeds.

Defined cases: a null or empty page, or one without words, gives the empty text; unclosed elements end with their parent or
the page; a tag ends at the first > outside of quotes, and where there is none, at the first >, from where on quotes don't
count any more; repeated rows are treated alike; of regions with equal sums the first, then the longest, is taken; an empty
table gives an empty result, and without labelled pages the default weights hold; very long and deeply nested pages and pages
of unclosed tags take time near their length; other columns pass through.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import bounded_batches, sampled, utf8

#: Element names by role.
_BLOCKS = set("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript iframe template svg math".split())
#: Elements that are never text, and those whose words aren't the main text.
_NEVER = set("noscript iframe template svg math head script style title textarea".split())
_PARTS = set("nav aside footer form button select option dialog menu".split())
#: What closes an open paragraph or item of the same list.
_SELF_CLOSING = set("p li dt dd option tr td th".split())
#: Words of class, id and role values that mark what isn't main text; fixed values.
_MARKS = set("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer header menu modal nav navbar navigation newsletter notice notices popup promo promoted recommended related respond sharing share sidebar social sponsor sponsored subscribe subscription toolbar widget complementary contentinfo search".split())
#: Words that may stand beside marks in the name of a part; fixed values.
_BESIDE = set("area bar bars block body bottom box boxes button buttons col column container first global group holder inner item items last left link links list main mobile module news outer page panel part posts primary right row secondary section side site slot sticky top unit user web wrap wrapper zone".split())
#: Reader comments can be longer than what they comment on, so their length doesn't make them the main text.
_READERS = set("comment comments disqus respond".split())
_CONTENT = ("article", "main")
#: Elements that text is made of.
_TEXT = "a abbr b blockquote br cite code dd dl dt em h1 h2 h3 h4 h5 h6 i img li mark ol p pre q s small span strong sub sup table tbody td th thead time tr u ul".split()

_OPENS = re.compile(r"<(?:!--|[!?]|/?[A-Za-z])")
#: What decides where a tag ends: its end, or the quote of a value.
_TAG_PART = re.compile(r"""[^>=]*+(?:>|=\s*+(["'])?)""")
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_SPLIT = re.compile(r"[^a-z]+")


#: Words by the part that they stand in: a part's element, or the first of its marks.
_WORDS_OF_PARTS = sorted(f"in {x}" for x in {*_PARTS, "header", *("#" + m for m in _MARKS)})


@dataclass(frozen=True)
class Weights:
    """Scores of words and tags, and as "in <part>" of words of parts; what isn't listed has `tag`."""

    word: float = 1.0
    tag: float = -0.45
    #: The defaults let text and headings in and keep an article's borders out.
    tags: dict[str, float] = field(default_factory=lambda: {**dict.fromkeys([x for t in _TEXT for x in (t, "/" + t)], -0.05), **dict.fromkeys(["article", "/article", "main", "/main"], -20.0), **dict.fromkeys(_WORDS_OF_PARTS, -1.0)})
    #: The most that a part beside the main text takes from a sum.
    part: float = 5.0

    def words(self, part: str | None) -> float:
        """The score of a word in the main text or in a part beside it, which costs as a tag does if it isn't listed."""
        return self.word if part is None else self.tags.get(f"in {part}", self.tag)


@dataclass(frozen=True)
class Training:
    #: Bound of the sample of pages with marked-up articles that weights are fitted on.
    max_pages: int = 2_000
    #: Counts that are added to either side together.
    prior: float = 5.0
    #: What a tag costs that stands inside of articles alone, and one that never does, in words.
    least_cost: float = 0.05
    wall: float = 20.0


def _marks(tag: str) -> set[str]:
    """Marks in class, id and role values of which each word is a mark or may stand beside one."""
    found = set()
    for m in _MARKED.finditer(tag):
        for value in (m[1] or m[2] or m[3] or "").lower().split():
            parts = {p for p in _SPLIT.split(value) if p}
            if parts <= _MARKS | _BESIDE:
                found |= parts & _MARKS
    return found


@dataclass
class _Seen:
    """What a pass over a page saw: words, whether an article without marks stands in it, and the same of each marked element by place."""

    words: int = 0
    article: bool = False
    marked: dict[int, list] = field(default_factory=dict)

    def wrappers(self) -> set[int]:
        """Marked elements that hold an article or, on a page without any, most of the words: wrappers of the main text."""
        most = lambda words, marks: not self.article and 2 * words > self.words and not marks & _READERS
        return {at for at, (marks, words, article) in self.marked.items() if article or most(words, marks)}


def tokens(page: str) -> Iterator[tuple[str, str, tuple[str, int] | None, bool]]:
    """(kind, value, part, inside an article) of the page: text with its words, and tags by name (closing ones with a slash).

    `part`: the outermost part beside the main text that holds the token, by name and place. What is never text isn't among the
    tokens. A mark doesn't make a part of an element that wraps the main text; which ones do is known after a first pass.
    """
    seen = _Seen()
    found = list(_scanned(page, set(), seen))
    wrappers = seen.wrappers()
    yield from _scanned(page, wrappers, _Seen()) if wrappers else found


class _Tags:
    """Finds where tags end, in one pass over the page."""

    def __init__(self, page: str) -> None:
        self.page, self.last, self.quoted, self.absent = page, page.rfind(">"), True, set()

    def end(self, at: int) -> int:
        """One past the end of the markup that opens at a place; -1 if no > follows."""
        page = self.page
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            return end + 3 if end >= 0 else len(page)
        if at > self.last:
            return -1
        if page[at + 1] in "!?" or not self.quoted:
            return page.index(">", at) + 1
        i = at + 2
        while m := _TAG_PART.match(page, i):
            i = m.end()
            if page[i - 1] == ">":
                return i
            if (quote := m[1]) and quote not in self.absent:
                close = page.find(quote, i)
                if close < 0:
                    self.absent.add(quote)  # nor is there one further on
                else:
                    i = close + 1
        self.quoted = False  # every > that follows is in quotes
        return page.index(">", at) + 1


def _scanned(page: str, wrappers: set[int], seen: _Seen) -> Iterator[tuple[str, str, tuple[str, int] | None, bool]]:
    # (name, part that it opens, never text, always a part, place if marked, words and articles seen when it opened)
    open_tags: list[tuple[str, bool, bool, bool, int | None, int, int]] = []
    by_name: dict[str, list[int]] = {}
    parts: list[tuple[str, int]] = []
    hidden, always_parts, inside, articles, at, tags = 0, 0, 0, 0, 0, _Tags(page)

    def close(k: int) -> None:
        nonlocal hidden, always_parts, inside
        for name, part, never, always, place, words, before in open_tags[k:]:
            if part:
                del parts[-1]
            hidden -= never
            always_parts -= always
            inside -= name in _CONTENT
            by_name[name].pop()
            if place is not None:
                seen.marked[place][1:] = [seen.words - words, articles > before]
        del open_tags[k:]

    def text(first: int, last: int) -> Iterator[tuple]:
        if first < last and not hidden:
            if not always_parts:
                seen.words += len(page[first:last].split())
            yield "text", page[first:last], parts[0] if parts else None, inside > 0

    while at < len(page):
        m = _OPENS.search(page, at)
        end = tags.end(m.start()) if m else -1
        if end < 0:
            # a tag that the end of the page cuts off isn't text
            cut = page.rfind("<", at)
            yield from text(at, cut if cut >= at and _OPENS.match(page, cut) else len(page))
            break
        yield from text(at, m.start())
        start, tag, at = m.start(), page[m.start() : end], end
        named = _NAME.match(tag)
        if not named:
            continue
        name = named[1].lower()
        if tag[1] == "/":
            held = parts[0] if parts else None
            if by_name.get(name):
                close(by_name[name][-1])
            if not hidden:
                yield "tag", "/" + name, held, inside > 0
            continue
        if name in _SELF_CLOSING and open_tags and open_tags[-1][0] == name:
            close(len(open_tags) - 1)
        never = name in _NEVER
        always, marks = name in _PARTS or name == "header" and not inside, _marks(tag)
        marked = bool(marks) and not always and not never and name not in ("html", "body", *_CONTENT)
        part = (name, start) if always else ("#" + min(marks), start) if marked and start not in wrappers else None
        if not hidden and not always_parts and (name == "main" or name == "article" and not marks):
            seen.article = True
            articles += 1
        if not hidden and not never:
            yield "tag", name, parts[0] if parts else part, inside > 0
        if name in _VOID or tag.endswith("/>") and name not in _RAW:
            continue
        if name in _RAW:
            ended = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = ended.end() if ended else len(page)
            continue
        by_name.setdefault(name, []).append(len(open_tags))
        open_tags.append((name, part is not None, never, always, start if marked else None, seen.words, articles))
        if marked:
            seen.marked[start] = [marks, 0, False]
        if part is not None:
            parts.append(part)
        hidden += never
        always_parts += always
        inside += name in _CONTENT
    close(0)


#: Tags whose counts are kept apart when weights are fitted; all others count together, so the table has a fixed size.
_KNOWN = sorted(_BLOCKS | _VOID | _RAW | _NEVER | _PARTS | set("a abbr b bdi bdo cite code data del dfn em i ins kbd label mark q rp rt ruby s samp small span strong sub sup time u var audio video canvas font".split()))
_KNOWN_TAGS = {*_KNOWN, *("/" + t for t in _KNOWN)}


def _counts(page: str) -> tuple[bool, Counter]:
    """Whether the page marks up an article, and counts of (token, inside): words as " " or by their part, tags by name, unknown ones as "?". Of a part's tags only its own count."""
    found, marked = Counter(), False
    for kind, value, part, inside in tokens(page):
        marked |= inside
        if kind == "text":
            found[f"in {part[0]}" if part else " ", inside] += len(value.split())
        elif part is None or value.lstrip("/") == part[0]:
            found[value if value in _KNOWN_TAGS else "?", inside] += 1
    return marked, found


def train(df: DataFrame, column: str = "html", how: Training = Training()) -> Weights:
    """Weights from a bounded sample of pages that mark up their article, chosen by hash. Only counts by tag reach the driver."""
    rows = df.select(F.coalesce(F.col(column), F.lit("")).alias("html")).where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    some = sampled(rows, "html", how.max_pages).distinct()

    def run(batches):
        for batch in batches:
            total = Counter()
            for page in utf8(batch.column(0)):
                marked, found = _counts(page.decode())
                if marked:
                    total += found
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.bool_()), pa.array(list(total.values()), pa.int64())], names=["token", "inside", "n"])

    counted = some.mapInArrow(run, "token string, inside boolean, n long")
    counts = {(r["token"], r["inside"]): r["n"] for r in counted.groupBy("token", "inside").agg(F.sum("n").alias("n")).collect()}
    if not counts:
        return Weights()
    share = lambda t: (counts.get((t, True), 0) + how.prior / 2) / (counts.get((t, True), 0) + counts.get((t, False), 0) + how.prior)
    cost = lambda t: -max(how.least_cost, how.wall * (1 - share(t)) ** 2)
    names = {t for t, _ in counts} - {" ", "?"}
    # words of parts count against a region even where articles are marked up around them, but less so
    learned = {t: -(1 - share(t) / 2) if t.startswith("in ") else cost(t) for t in names}
    return Weights(round(share(" "), 4), tags=Weights().tags | {t: round(v, 4) for t, v in learned.items()})


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and one past the last of the contiguous scores with the largest positive sum; the first such, then the longest. (0, 0) without any."""
    best, run, start, region = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best or run == best > 0 and region[0] == start:
            best, region = run, (start, i + 1)
    return region


def extract(page: str, weights: Weights) -> str:
    """The main text of one page: the words of the best region that don't score negative, by blocks."""
    blocks: list[list[str]] = [[]]
    scores, block_of = [], []
    last_part, left = None, 0.0
    for kind, value, part, _ in tokens(page):
        if part != last_part:
            last_part, left = part, weights.part
        if kind == "tag":
            score, kept = weights.tags.get(value, weights.tag), False
            if value.lstrip("/") in _BLOCKS and blocks[-1]:
                blocks.append([])
        else:
            n, each = len(value.split()), weights.words(part and part[0])
            score, kept = each * n, each >= 0
            if kept and (n or blocks[-1]):
                blocks[-1].append(value)
            if not n:
                continue
        if part is not None and score < 0:
            score = -min(-score, left)
            left += score
        scores.append(score)
        block_of.append(len(blocks) - 1 if kept else None)
    first, last = best_region(scores)
    reached = {b for b in block_of[first:last] if b is not None}
    texts = (" ".join(html.unescape("".join(blocks[b])).split()) for b in sorted(reached))
    return "\n".join(t for t in texts if t)


def main_text(df: DataFrame, weights: Weights | None = None, column: str = "html", out: str = "text") -> DataFrame:
    """Adds the main text of each page, replacing a column of that name. Weights that aren't given are trained on df."""
    weights = train(df, column) if weights is None else weights
    bounded_batches(df.sparkSession)
    keep = [f for f in df.schema.fields if f.name != out]

    def run(batches):
        for batch in batches:
            texts = [extract(p.decode(), weights) for p in utf8(batch.column(batch.schema.get_field_index(column)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(f.name)) for f in keep), pa.array(texts, pa.string())], names=[*(f.name for f in keep), out])

    return df.mapInArrow(run, T.StructType([*keep, T.StructField(out, T.StringType())]))


def digest(df: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of all rows."""
    return main_text(df.select("page_id", "url", "html")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
