"""Main text of web pages by equivalence-class template deduction.

Pages of a host come from one template. A page is read as tokens: tags with the chain of
containers around them, and stretches of text with theirs. Tokens with the same occurrence
vector over the pages of a host (as often on each page) form an equivalence class; classes
of enough tokens that are on a large share of the pages belong to the template. Pages
without tokens don't count. A class is valid on a page if its tokens are there in the class's order, and if it nests: all of it lies in one gap of
each larger class that it meets. Text tokens of valid classes are boilerplate. What is left
between the tokens of the template are its slots, and the main text is made of the slots in
the article, outside menus, notices and the like.

An occurrence vector is kept as the exclusive or of a hash for each page and count, so that
vectors are grouped with partial sums and no list of pages; a host may have any number of
pages.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow, stage_table

#: hosts with fewer pages show no template
MIN_PAGES = 10
#: share of a host's pages that a class must be on
MIN_SHARE = 0.8
#: tokens that a class must have
MIN_CLASS = 3
#: template tokens of all hosts together (24 bytes each) that may be broadcast
BROADCAST_TOKENS = 2_000_000

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object textarea xmp".split())
CONTAINERS = frozenset("html head title body nav header footer aside form menu dialog article main section div ul ol dl table figure fieldset select button".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody tfoot thead title tr ul".split())
#: tags that part words inside a block
SPACES = frozenset(("br", "td", "th"))
#: containers that are no part of an article
NOISE_TAGS = frozenset("head title nav aside footer form menu dialog select button fieldset".split())
#: names of classes and ids for layout around an article; an article may lie in such an element
LAYOUT_WORDS = frozenset("banner breadcrumb breadcrumbs footer header masthead menu nav navbar navigation notice notices sidebar toolbar widget widgets".split())
#: names for what is no article, wherever it lies and even if it is marked up as one
OTHER_WORDS = frozenset("ad ads advert adverts advertisement advertisements advertising comment comments cookie cookies consent disqus modal newsletter paywall popup promo promoted promotion promotions recommendation recommendations recommended related replies reply respond share sharing social sponsor sponsored subscribe subscription teaser teasers".split())
#: last words of a name that only say what the word before them names
GENERIC_WORDS = frozenset("area articles bar block body box btn button buttons card cards container content feed form grid group holder icons inner item items layer link links list outer overlay panel placeholder posts row section signup slot slots stories thread unit wrap wrapper zone".split())
#: a name with one of these tells about another element
STATE_WORDS = frozenset("has is no not with without".split())
MAIN = frozenset(("article", "main"))
#: attributes that tell containers apart
MARKS = frozenset(("class", "id", "role"))

_NEXT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^=>]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)|[^<]+|<", re.DOTALL)
_ATTR = re.compile(r"([^\s=\"'/]++)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z0-9]+")
#: elements that end where another one begins: a paragraph at any block, others at their like
ENDS = {"p": BLOCKS, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "option": frozenset(("option",)), "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr"))}


@lru_cache(1 << 16)
def mark_of(names: str, in_main: bool) -> int:
    """What the value of a class or id marks its element as: 2 no article, 1 layout, 0 neither. The head noun of a name
    decides: ``related-posts`` and ``post-comments`` are no article, ``share-price`` and ``has-sidebar`` mark nothing. A
    header in an article is its own."""
    found = 0
    for name in names.split():
        words = [w.lower() for w in _WORD.findall(name)]
        if not words or STATE_WORDS.intersection(words):
            continue
        while len(words) > 1 and words[-1] in GENERIC_WORDS:
            words.pop()
        if words[-1] in OTHER_WORDS:
            return 2
        if words[-1] in LAYOUT_WORDS and not (in_main and words[-1] == "header"):
            found = 1
    return found


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", url or "")
    return m[1].lower() if m else ""


class Page:
    """Tokens of a page, in order: hash, text (None for a tag), what a tag parts (2: blocks, 1: words, 0: nothing),
    in an article, number of the container. ``noise`` says of each container whether it is no part of an article. It is
    none if its tag, class or id says so, or if it lies in one that is none. Layout names mark no article itself, and where
    all articles lie in elements with layout names, these count only if they hold none."""

    def __init__(self, source: str):
        self.tokens: list[tuple[int, str | None, int, bool, int]] = []
        #: containers in the order that they open: the one around, marked by the tag, by a class or id, an article, holds one
        around, by_tag, by_name, article, holds = [0], [False], [0], [False], [False]
        digest = xxhash.xxh64_intdigest
        #: open containers: name, hash of the path to it, number, articles on the path
        stack: list[tuple[str, int, int, int]] = [("", 0, 0, 0)]
        #: how many of each name are open, and of the names that are no containers
        opened: Counter = Counter()
        at = 0
        while m := _NEXT.match(source, at):
            at = m.end()
            name = m[2]
            _, path, box, main = stack[-1]
            if name is None:
                part = m[0]
                if part[0] == "<" and len(part) > 1:
                    continue
                text = part if part.isspace() else html_lib.unescape(part)
                self.tokens.append((digest(f"{path}|{_SPACE.sub(' ', text).strip()}"), text, 0, main > 0, box))
                continue
            name = name.lower()
            closing, attrs = bool(m[1]), m[3]
            if name in RAW and not closing:
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*(?:>|\\Z)|\\Z", re.IGNORECASE).search(source, at)
                at = end.end()
                self.tokens.append((digest(f"{path}<{name}>"), None, 0, main > 0, box))
                continue
            if not closing and name in ENDS.get(stack[-1][0], ()):
                opened[stack.pop()[0]] -= 1        # a marked paragraph or item ends here
                _, path, box, main = stack[-1]
            marks = [a[1] or a[2] or a[3] for a in _ATTR.findall(attrs) if a[0].lower() in MARKS] if attrs and not closing else []
            known = " ".join(sorted(x for a in marks for x in re.split(r"[\s_-]+", a.lower())))
            self.tokens.append((digest(f"{path}<{m[1]}{name} {known}>"), None, 2 if name in BLOCKS else int(name in SPACES), main > 0, box))
            if closing:
                if opened[name]:
                    while True:
                        last = stack.pop()[0]
                        opened[last] -= 1
                        if last == name:
                            break
                continue
            if name in VOID or attrs.rstrip().endswith("/"):
                continue
            mark = max((mark_of(a, main > 0) for a in marks), default=0) if name not in ("html", "body") else 0
            # other elements are containers if they are marked, or lie in a marked one of their name
            if name in CONTAINERS or mark or opened[name]:
                around.append(box)
                by_tag.append(name in NOISE_TAGS or (name == "header" and not main))
                by_name.append(mark if mark == 2 or name not in MAIN else 0)
                article.append(name in MAIN)
                holds.append(False)
                stack.append((name, digest(f"{path}/{name}"), len(around) - 1, main + (name in MAIN)))
                if name in MAIN:
                    up = len(around) - 1
                    while up and not holds[up]:
                        holds[up] = True
                        up = around[up]
                opened[name] += 1

        def spread(own: list[bool]) -> list[bool]:
            out = [False]
            for k in range(1, len(around)):
                out.append(out[around[k]] or own[k])
            return out

        self.noise = spread([t or n > 0 for t, n in zip(by_tag, by_name, strict=True)])
        if any(holds) and all(self.noise[k] for k in range(len(around)) if article[k]):
            self.noise = spread([t or n == 2 or (n == 1 and not h) for t, n, h in zip(by_tag, by_name, holds, strict=True)])

    def counts(self) -> tuple[Counter, dict[int, int]]:
        """How often each token is there, and where first. Stretches of white space aren't tokens of a template."""
        first: dict[int, int] = {}
        n: Counter = Counter()
        for k, (h, text, *_) in enumerate(self.tokens):
            if text is None or not text.isspace():
                n[h] += 1
                first.setdefault(h, k)
        return n, first

    def boilerplate(self, template: list[tuple[int, int]]) -> set[int]:
        """Tokens of the valid classes: ``template`` lists (class, token) by class and order in it."""
        first = self.counts()[1]
        classes: dict[int, list[int]] = {}
        for c, token in template:
            classes.setdefault(c, []).append(token)
        valid: list[list[int]] = []
        out: set[int] = set()
        for tokens in sorted(classes.values(), key=lambda t: (-len(t), t)):
            places = [first.get(t, -1) for t in tokens]
            if places[0] < 0 or any(a >= b for a, b in zip(places, places[1:])):
                continue  # not ordered on this page
            if any(np.searchsorted(v, places[0]) != np.searchsorted(v, places[-1]) for v in valid):
                continue  # not nested
            valid.append(places)
            out.update(tokens)
        return out

    def main_text(self, boilerplate: set[int]) -> str:
        """Slots of the article as blocks. If that leaves nothing, all pages of the host have this article, and it stays."""
        inside = any(t[3] and not self.noise[t[4]] for t in self.tokens)
        for skip in (boilerplate, ()):
            blocks, block = [], []
            for h, text, breaks, in_main, box in self.tokens:
                if text is None:
                    if breaks == 2:
                        blocks.append("".join(block))
                        block = []
                    elif breaks:
                        block.append(" ")
                elif not self.noise[box] and (in_main or not inside) and h not in skip:
                    block.append(text)
            blocks.append("".join(block))
            done = [b for b in (_SPACE.sub(" ", x).strip() for x in blocks) if b]
            if done:
                return "\n\n".join(done)
        return ""


_HOST = "lower(coalesce(regexp_extract(`__url`, '^\\\\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)', 1), ''))"


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each host of a batch: its pages there (as token 0), and its tokens with the pages that have them."""
    for b in batches:
        found: dict[int, dict[int, list[int]]] = {}
        for row, host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            n, first = Page(source or "").counts()
            if not n:
                continue
            seen = found.setdefault(host, {0: [0, 0, 0]})
            seen[0][2] += 1
            vectors: dict[int, int] = {}
            for t, k in n.items():
                if (v := vectors.get(k)) is None:
                    v = vectors[k] = xxhash.xxh64_intdigest(f"{row}:{k}")
                if (old := seen.get(t)) is None:
                    seen[t] = [v, first[t], 1]
                else:
                    old[0] ^= v
                    old[1] += first[t]
                    old[2] += 1
        hosts = pa.array(np.repeat(np.array([*found], np.int64), [len(x) for x in found.values()]))
        tokens = np.array([t for x in found.values() for t in x], np.uint64).view(np.int64)
        values = np.array([v for x in found.values() for v in x.values()], np.uint64).view(np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([hosts, pa.array(tokens), *(pa.array(np.ascontiguousarray(values[:, k])) for k in range(3))], names=["host", "token", "vector", "places", "pages"])


def templates(pages: DataFrame) -> DataFrame:
    """``host``, ``template``: array of (class, order, token) of each host with enough pages. ``pages`` has ``__row``, ``host``, ``__html``."""
    seen = map_arrow(pages.select("__row", "host", "__html"), _tokens, "host long, token long, vector long, places long, pages long")
    by = seen.groupBy("host", "token").agg(F.bit_xor("vector").alias("vector"), F.sum("places").alias("places"), F.sum("pages").alias("pages"))
    # a token on fewer pages is in no template of any host
    by = stage_table(by.filter(F.col("pages") >= math.ceil(MIN_SHARE * MIN_PAGES)), "page-tokens")
    hosts = by.filter("token = 0").filter(F.col("pages") >= MIN_PAGES).select("host", F.col("pages").alias("all_pages"))
    common = by.filter("token <> 0").join(hosts, "host").filter(F.col("pages") >= MIN_SHARE * F.col("all_pages"))
    classes = common.groupBy("host", "vector").agg(F.count("*").alias("n"), F.collect_list(F.struct("places", "token")).alias("tokens")).filter(F.col("n") >= MIN_CLASS)
    return classes.groupBy("host").agg(F.flatten(F.collect_list(F.transform(F.array_sort("tokens"), lambda t: F.struct(F.col("vector").alias("class"), t["places"].alias("place"), t["token"].alias("token"))))).alias("template"))


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col`` and ``text`` of every page.

    A null or empty page has an empty text; pages without a host form one; hosts of fewer
    than ``MIN_PAGES`` pages have no template and give all text of the article. Repeated
    rows each give a row; other columns are left out; an empty table gives an empty result.
    """
    src = pages.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("__id"), F.col(url_col).cast("string").alias("__url"), F.col(html_col).cast("string").alias("__html"))
    src = src.withColumn("host", F.xxhash64(F.expr(_HOST)))
    found = stage_table(templates(src), "templates")
    size = found.agg(F.sum(F.size("template"))).first()[0] or 0
    found = F.broadcast(found) if size <= BROADCAST_TOKENS else found
    joined = src.join(found, "host", "left").select("__id", "__url", "__html", "template.class", "template.token")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for source, classes, tokens in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                page = Page(source or "")
                template = [(c, t & 0xFFFFFFFFFFFFFFFF) for c, t in zip(classes or (), tokens or (), strict=True)]
                out.append(page.main_text(page.boilerplate(template)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=[id_col, url_col, "text"])

    return map_arrow(joined, run, f"`{id_col}` {src.schema['__id'].dataType.simpleString()}, `{url_col}` string, text string")
