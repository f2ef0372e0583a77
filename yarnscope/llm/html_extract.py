"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. A word scores what its place says: the
share of words in that place (innermost block tag and section, with class
names) that belong to the article, in pages that mark it, scaled to -1 .. 1. A
tag scores minus the share of such tags outside the article. The contiguous
stretch of the sequence with the greatest sum, found by one linear scan, is
the content region; its blocks are the text, less blocks that are of another
kind by their element or class (menus, adverts, comments and so on). What a
class name means is learned from the labelled pages; a name not seen there is
of another kind only if all its words say so.

Weights are learned from at most SAMPLE pages that mark an article, chosen by
a hash; places not seen there fall back to their block tag, then to fixed
weights.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pages that weights are learned from.
SAMPLE = 2000

#: Elements whose content is never text of the page.
SILENT = frozenset("script style noscript template iframe svg math head title textarea select option button object canvas audio video".split())
#: Silent elements whose content is no markup: it ends at their own end tag only.
RAW = frozenset("script style title textarea iframe noscript".split())
#: Elements of the head; any other start tag, or a word, ends a head without end tag.
HEAD = frozenset("base link meta script style title noscript template".split())
#: Elements that hold no content of the article.
ASIDE = frozenset("nav footer aside form menu dialog".split())
#: Elements that end a block.
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Class or id words of elements that hold no content of the article.
OTHER = frozenset("""ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer
    form login menu modal nav navbar navigation newsletter notice notices notification pagination popup promo promoted related share sharing
    sidebar signup skip social sponsor sponsored subscribe toolbar widget
    kommentar kommentare commentaire commentaires comentario comentarios commenti werbung anzeige publicidad publicité hinweis aviso""".split())

#: Words that say where or how something stands, not what it is.
NEUTRAL = frozenset("""area bar block body bottom box button buttons center col column container content foot group head header holder icon icons inner
    item items layout left link links list main message outer panel post posts right row section site text title top wrap wrapper""".split())

_CLASS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORD = re.compile(r"[^\W\d_A-Z]+|[A-Z][^\W\d_A-Z]*")
_NAME = re.compile(r"[a-zA-Z]")
_NAME_END = re.compile(r"[\s/>]")
_SPECIAL = re.compile(r"[>\"']")
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in RAW}
#: A slash at the end of a tag that belongs to a value without quotes.
_VALUE_SLASH = re.compile(r"=\s*[^\s\"'=]*/\s*\Z")
#: Weight at or below which an element with such a class token holds no content, and words a token must be seen with.
NEVER, EVIDENCE = -0.95, 20


class Tags:
    """Tags of a page, each found in time linear in the page however broken the mark-up is.

    What one failed search saw is remembered: where the next delimiter is, and
    the quotes from which no end of a tag is reached.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in "<>\"'"}
        self.name_end = self.special = (0, -1)  # (from, place): the first such character at or after any place between
        self.closed = set()  # quotes that lead to no end

    def _next(self, pattern, seen, at):
        if not seen[0] <= at <= seen[1]:
            m = pattern.search(self.page, at)
            seen = (at, m.start() if m else len(self.page))
        return seen

    def tag_at(self, at: int):
        """``(end, slash, name, attributes)`` of the tag that begins at the ``<`` at ``at``, or None if none does."""
        page, start = self.page, at + 1
        slash = page.startswith("/", start)
        start += slash
        if at > self.last[">"] or not _NAME.match(page, start):
            return None
        self.name_end = self._next(_NAME_END, self.name_end, start)
        begin = pos = self.name_end[1]
        visited = []
        while True:
            self.special = self._next(_SPECIAL, self.special, pos)
            pos = self.special[1]
            if pos < len(page) and page[pos] == ">":
                return pos + 1, slash, page[start:begin].lower(), page[begin:pos]
            if pos >= len(page) or pos in self.closed or pos >= self.last[page[pos]]:
                self.closed.update(visited)
                return None
            visited.append(pos)
            pos = page.index(page[pos], pos + 1) + 1


def class_tokens(attributes: str) -> tuple[str, ...]:
    """Names in class, id and role, lower-cased, with their letter case kept where it parts words (as ``-``)."""
    out = []
    for c in _CLASS.finditer(attributes):
        for token in (c.group(1) or c.group(2) or c.group(3) or "").split():
            out.append("-".join(w.lower() for w in _WORD.findall(token)))
    return tuple(t for t in dict.fromkeys(out) if t)


def listed(token: str) -> bool:
    """Whether a name says that its element is of another kind: a word of OTHER, and besides only words that say where or how."""
    words = set(token.split("-"))
    return bool(words & OTHER) and words <= OTHER | NEUTRAL


def is_other(tokens, weights: dict[str, float]) -> bool:
    """Whether an element is of another kind: what the labelled pages say of its names, else the names themselves."""
    return any(weights["." + t] <= NEVER if "." + t in weights else listed(t) for t in tokens)


class _Open:
    __slots__ = ("name", "excluded", "inside", "tokens", "words", "article", "section", "live")

    def __init__(self, name, excluded, inside, tokens, words, article, section):
        self.name, self.excluded, self.inside, self.tokens = name, excluded, inside, tokens
        self.words, self.article, self.section, self.live = words, article, section, True


class _Stack:
    """Open elements. Every question that a tag asks is answered in constant time, apart from what it closes."""

    def __init__(self):
        self.all, self.blocks, self.sections, self.classed, self.by_name = [], [], [], [], {}
        self.excluded = self.inside = 0
        self.words = self.article = 0  # words so far, and those inside an article
        self.closed = []  # (tokens, words, words inside an article)

    def push(self, e: _Open):
        at = len(self.all)
        self.all.append(e)
        self.by_name.setdefault(e.name, []).append(at)
        if e.name in BLOCK:
            self.blocks.append(at)
        if e.section:
            self.sections.append(at)
        if e.tokens:
            self.classed.append(at)
        self.excluded += e.excluded
        self.inside += e.inside

    def _close(self, e: _Open):
        e.live = False
        self.excluded -= e.excluded
        self.inside -= e.inside
        if e.tokens:
            self.closed.append((e.tokens, self.words - e.words, self.article - e.article))

    def cut(self, at: int):
        """Closes the element at ``at`` and all opened after it."""
        while len(self.all) > at:
            e = self.all.pop()
            if e.live:
                self.by_name[e.name].pop()
                self._close(e)
        for places in (self.blocks, self.sections, self.classed):
            while places and places[-1] >= at:
                places.pop()

    def end(self, name: str):
        """An end tag. That of an inline element never ends the blocks opened inside it."""
        if not self.by_name.get(name):
            return
        at = self.by_name[name][-1]
        if name in BLOCK or not self.blocks or self.blocks[-1] < at:
            self.cut(at)
        else:
            self.by_name[name].pop()
            self._close(self.all[at])

    def before_block(self, name: str):
        """A block ends an open paragraph, an item the item before it."""
        if self.blocks:
            top = self.all[self.blocks[-1]].name
            if top == "p" or (top == name and name in ("li", "td", "th", "tr", "dd", "dt")):
                self.cut(self.blocks[-1])

    def top(self, places):
        while places and not self.all[places[-1]].live:
            places.pop()
        return self.all[places[-1]] if places else None


def page_blocks(page: str, weights: dict[str, float] | None = None, closed: list | None = None):
    """Blocks ``(place, excluded, in_article, words, tags before, class tokens)`` of a page, in order.

    ``place`` is ``section|block``; ``tags before`` are the tags since the last
    block, with a ``+`` inside an article; the tokens are those of the innermost
    element with any. ``words`` are the decoded words. ``closed``, if given,
    receives every element with tokens: ``(tokens, words, words inside an article)``.
    """
    weights = weights or {}
    blocks, stack, found = [], _Stack(), Tags(page)
    text, tags = [], []
    closing = None  # a silent element whose end is awaited
    in_head = False

    def flush():
        words = entities.unescape("".join(text)).split()
        text.clear()
        if words:
            block = stack.all[stack.blocks[-1]].name if stack.blocks else "body"
            section, classed = stack.top(stack.sections), stack.top(stack.classed)
            blocks.append((f"{section.section if section else ''}|{block}", stack.excluded > 0, stack.inside > 0, words, list(tags),
                           classed.tokens if classed else ()))
            tags.clear()
            stack.words += len(words)
            stack.article += len(words) if stack.inside else 0

    pos = 0
    while pos < len(page):
        tag = None
        if page[pos] == "<":
            if page.startswith("<!--", pos):
                end = page.find("-->", pos + 4)
                pos = end + 3 if end >= 0 else len(page)
                continue
            if page.startswith(("<!", "<?"), pos) and pos < found.last[">"]:
                pos = page.index(">", pos) + 1
                continue
            tag = found.tag_at(pos)
        if tag is None:
            end = page.find("<", pos + 1) if pos < found.last["<"] else -1
            end = end if end >= 0 else len(page)
            if closing is None:
                piece = page[pos:end]
                in_head = in_head and not piece.strip()
                text.append(piece)
            pos = end
            continue
        pos, slash, name, rest = tag
        opens = not slash and (not rest.rstrip().endswith("/") or _VALUE_SLASH.search(rest) is not None)
        if opens and name in RAW:
            in_head = in_head and name in HEAD
            end = _RAW_END[name].search(page, pos)
            pos = end.start() if end else len(page)
            continue
        if closing == "option" and (name in BLOCK or name in ("datalist", "optgroup", "select")):
            closing = None  # its end tag may be missing
        if closing is not None:
            if slash and name == closing:
                closing = None
            continue
        if name == "head":
            in_head = not slash
            continue
        if in_head:
            in_head = name in HEAD or bool(slash) and name not in BLOCK
            if in_head and name != "template":
                continue
        if name in SILENT:
            if opens:
                closing = name
            continue
        within = "+" if stack.inside else ""  # tags inside an article are told apart
        if name in VOID:
            if name in BLOCK:
                flush()
            elif name in ("br", "wbr"):
                text.append(" " if name == "br" else "")
            tags.append(within + name)
            continue
        if name in BLOCK:
            flush()
        tags.append(within + name)
        if slash:
            stack.end(name)
            continue
        if name in BLOCK and name != "html":
            stack.before_block(name)
        tokens = class_tokens(rest) if rest else ()
        other = bool(tokens) and name not in ("html", "body", "article", "main") and is_other(tokens, weights)
        excluded = other or name in ASIDE or (name == "header" and not stack.inside)
        section = name + ".other" if other else name if name in ASIDE or name in ("header", "article", "main", "section") else ""
        stack.push(_Open(name, excluded, stack.inside > 0 or name in ("article", "main"), tokens, stack.words, stack.article, section))
    if closing is None or text:
        flush()
    if closed is not None:
        stack.cut(0)
        closed.extend(stack.closed)
    return blocks


def best_region(scores) -> tuple[int, int]:
    """First and last place (half open) of the contiguous stretch with the greatest sum; the earliest, shortest one of equals."""
    best, bounds, total, begin = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, k
        total += s
        if total > best:
            best, bounds = total, (begin, k + 1)
    return bounds


def main_text(page: str, weights: dict[str, float]) -> str:
    """Blocks of the content region, joined by line feeds."""
    blocks = page_blocks(page, weights)
    marked = any(inside for _, _, inside, _, _, _ in blocks)
    scores = []
    # every block counts as its tags, then its words; the words of a block score alike
    for place, excluded, inside, words, tags, tokens in blocks:
        if excluded:
            # excluded blocks go anyway; they weigh little, so that one inside the article does not split it
            each = 0.0 if inside else -0.1
        else:
            # places never seen: what the page itself marks, if it does
            each = weights.get(place, weights.get(place.rpartition("|")[2], -0.5 if marked and not inside else 0.5))
            said = [weights["." + t] for t in tokens if "." + t in weights]
            if said:  # a name says more than no section
                each = min(said) if place.startswith("|") else (each + min(said)) / 2
        scores.append(sum(weights.get("<" + t, -0.02 if t[0] == "+" else -0.3) for t in tags))
        scores.append(each * len(words))
    first, last = best_region(scores)
    return "\n".join(" ".join(words) for k, (_, excluded, _, words, _, _) in enumerate(blocks) if first <= 2 * k + 1 < last and not excluded)


def _marked(page: str) -> bool:
    low = page.lower()
    return low.count("<article") == 1


def learn_weights(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weights of places (``section|block`` and ``block``), of tags (``<tag``) and of class tokens (``.token``) from pages with one article.

    A token is weighed by the words of its elements inside and outside the
    article; an element with a listed name that holds less than half of the
    article counts as outside, as it is a part of another kind.
    """
    schema = pa.schema([("what", pa.string()), ("inside", pa.int64()), ("outside", pa.int64())])

    def count(batches):
        for batch in batches:
            found = Counter()
            for page in batch.column("html"):
                page = page.as_py()
                if not _marked(page):
                    continue
                closed = []
                blocks = page_blocks(page, closed=closed)
                article = sum(len(words) for _, _, inside, words, _, _ in blocks if inside)
                holders = {"." + t: 1.0 for tokens, _, within in closed for t in tokens if listed(t) and 0 < article <= 2 * within}
                if holders:  # a listed name around the article itself
                    blocks = page_blocks(page, holders)
                for tokens, n, within in closed:
                    for t in tokens:
                        within_ = 0 if listed(t) and 2 * within < article else within
                        found["." + t, 0] += within_
                        found["." + t, 1] += n - within_
                for place, excluded, inside, words, tags, _ in blocks:
                    side = 0 if inside and not excluded else 1
                    found[place, side] += len(words)
                    if not excluded:
                        found[place.rpartition("|")[2], side] += len(words)
                    for t in tags:
                        found["<" + t, side] += 1
            names = sorted({k for k, _ in found})
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([found[k, 0] for k in names], pa.int64()),
                                              pa.array([found[k, 1] for k in names], pa.int64())], schema=schema)

    # a draw that leaves about four times the sample, then the least hashes
    draw = F.pmod(F.xxhash64("page_id", F.lit(3)), F.lit(1 << 40))
    html = F.xxhash64(F.col("html").cast("string"))
    some = pages.where("html is not null").where(draw.cast("double") * float(max(1, pages.count())) < 4.0 * sample * (1 << 40))
    chosen = some.select("page_id", html.alias("hash__"), draw.alias("draw__")).distinct().orderBy("draw__", "page_id", "hash__").limit(sample)
    chosen = chosen.select(F.col("page_id").alias("id__"), "hash__")
    here = F.col("page_id").eqNullSafe(F.col("id__")) & (html == F.col("hash__"))
    # repeated rows of a drawn page count once
    texts = pages.where("html is not null").join(F.broadcast(chosen), here, "left_semi").select(F.col("html").cast("string").alias("html"))
    texts = texts.groupBy(F.xxhash64("html").alias("hash__")).agg(F.min("html").alias("html")).select("html")
    rows = texts.mapInArrow(count, "what string, inside long, outside long").groupBy("what") \
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).orderBy("what").collect()  # places of at most sample pages
    out = {}
    for r in rows:
        if r["what"].startswith(".") and r["inside"] + r["outside"] < EVIDENCE:
            continue
        share = (r["inside"] + 0.5) / (r["inside"] + r["outside"] + 1)
        most = 0.05 if r["what"].startswith("<+") else 0.5
        out[r["what"]] = -max(0.02, min(most, 1 - share)) if r["what"].startswith("<") else 2 * share - 1
    return out


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``pages(page_id, url, html)``: ``page_id, url, text``.

    Character references are decoded, white space inside a block becomes one
    blank. Null or empty html, and pages without words, give an empty text.
    Pages without article mark-up are scored with the same weights. Repeated
    rows give equal results; further columns are ignored. Time is linear in the
    length of a page, also of broken or very deep mark-up.
    """
    model = pages.sparkSession.sparkContext.broadcast(learn_weights(pages, sample))  # numbers of the places in at most sample pages

    def run(batches):
        for batch in batches:
            texts = [main_text(p.as_py() or "", model.value) for p in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, T.StructType([*rows.schema[:2], T.StructField("text", T.StringType())]))
