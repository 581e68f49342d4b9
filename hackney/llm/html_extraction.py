"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into its leaf blocks: runs of text between the borders of
block-level elements. Each block has features of its ancestors' tags and class
names and of its text. The field is trained on labelled pages, and the best path
tells which blocks are the article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm import chain
from hackney.llm.frames import kind_of, map_slices, pick

# Labelled pages that the fit takes from the corpus.
SAMPLE = 200
# Layouts that each labelled page's blocks are set into besides its own.
RELAID = 5
REMEMBERED = 1 << 16

# Elements that neither hold text of their own nor part a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
# Elements whose content is no markup; of these only a text area would show it.
RAW = frozenset("script style title textarea noscript template iframe svg math object".split())
# An opening tag of the key ends an open element of the value, within the nearest of the borders.
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6".split())
ENDED_BY_SAME = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "option": "select"}

MEANINGFUL = frozenset("article main nav header footer aside form section dialog select button".split())

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)"""
    r"""|<([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<[A-Za-z][^>]*(?:>|\Z)""",
    re.DOTALL,
)
_CLASS = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")


class Block(NamedTuple):
    """A run of text, the path of block elements above it (tag and class words), and how much of it is linked.

    Of equal elements above the last two the path has the nearest only, so that it stays short however deep the text lies.
    """

    text: str
    path: tuple[str, ...]
    linked: int


class _Path:
    """The open block elements, and where each kind of tag and of element is open."""

    def __init__(self) -> None:
        self.open: list[tuple[str, str]] = []
        self.tags: dict[str, int] = {}
        self.places: dict[str, list[int]] = {}
        self.told: tuple[str, ...] | None = ()

    def push(self, tag: str, element: str) -> None:
        self.tags[tag] = self.tags.get(tag, 0) + 1
        self.places.setdefault(element, []).append(len(self.open))
        self.open.append((tag, element))
        self.told = None

    def pop(self) -> str:
        tag, element = self.open.pop()
        self.tags[tag] -= 1
        self.places[element].pop()
        if not self.places[element]:
            del self.places[element]
        self.told = None
        return tag

    def elements(self) -> tuple[str, ...]:
        """The different open elements by their nearest place, and the last two as they stand."""
        if self.told is None:
            self.told = tuple(sorted(self.places, key=lambda e: self.places[e][-1]))
            if len(self.open) > 1 and self.open[-1] == self.open[-2]:
                self.told += self.told[-1:]
        return self.told


def leaf_blocks(page: str) -> list[Block]:
    """Blocks of text in page order: references decoded, white space made one space, empty ones left out."""
    found: list[Block] = []
    path = _Path()
    parts: list[str] = []
    linked, link_depth, at, end = 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append(Block(text, path.elements(), linked))
            parts.clear()
        linked = 0

    while at < end:
        match = _MARKUP.search(page, at)
        text = page[at : match.start() if match else end]
        if text:
            parts.append(text)
            if link_depth:
                linked += len(text.strip())
        if not match:
            break
        at = match.end()
        closing, opening = match[1], match[2]
        if closing:
            tag = closing.lower()
            if tag == "a":
                link_depth = 0
            elif tag not in INLINE and tag not in VOID:
                if path.tags.get(tag):
                    flush()
                    while path.pop() != tag:
                        pass
                elif tag == "p":
                    flush()
        elif opening:
            tag = opening.lower()
            if tag == "a":
                link_depth = 1
            elif tag in ("br", "hr", "wbr"):
                if tag == "hr":
                    flush()
                elif tag == "br":
                    parts.append(" ")
            elif tag in RAW:
                if not match[0].endswith("/>"):
                    close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                    at = close.end() if close else end
            elif tag not in INLINE and tag not in VOID:
                flush()
                above = path.open
                if above and above[-1][0] in PARAGRAPHS and (above[-1][0] == "p" or tag in PARAGRAPHS):
                    path.pop()
                ended = ("dt", "dd") if tag in ("dt", "dd") else (tag,)
                if tag in ENDED_BY_SAME and any(path.tags.get(t) for t in ended):
                    borders = ENDED_BY_SAME[tag].split()
                    for i in range(len(above) - 1, -1, -1):
                        if above[i][0] in borders:
                            break
                        if above[i][0] in ended:
                            while len(above) > i:
                                path.pop()
                            break
                names = " ".join(filter(None, (m[1] or m[2] or m[3] for m in _CLASS.finditer(match[3] or ""))))
                path.push(tag, f"{tag} {names.lower()}" if names else tag)
    flush()
    return found


def path_features(path: tuple[str, ...]) -> list[str]:
    """Tags and class words of the block's own element, of those above it, and of the nearest with a telling name."""
    names, tags = [], []
    for element in path:
        tag, _, classes = element.partition(" ")
        tags.append(tag)
        names += [f"c={w}" for w in _WORDS.findall(classes)]
    told = [f"own={tags[-1] if tags else ''}", *{f"in={t}" for t in tags if t not in ("html", "body")}, *set(names)]
    if path:
        told += [f"near={w}" for w in _WORDS.findall(path[-1].partition(" ")[2])]
        told.append(f"two={'>'.join(tags[-2:])}")
    # What the block stands in, past lists and tables: the nearest element that has a name or a meaning.
    for element in reversed(path):
        tag, _, classes = element.partition(" ")
        if classes or tag in MEANINGFUL:
            told += [f"frame={tag}", *(f"frame={w}" for w in _WORDS.findall(classes))]
            break
    return told


def text_key(block: Block) -> tuple[int, int, bool, bool, bool]:
    """What of a block's text counts: length, share of it in links, a sentence's end, marks of rights, bars."""
    n = len(block.text)
    return (
        min(6, n.bit_length()),
        min(4, 4 * block.linked // n),
        block.text[-1] in ".!?…»\"'”",
        "©" in block.text or "(c)" in block.text.lower(),
        "|" in block.text or "·" in block.text,
    )


def text_features(key: tuple[int, int, bool, bool, bool]) -> list[str]:
    return [f"t{i}={value}" for i, value in enumerate(key)]


def block_features(block: Block) -> list[int]:
    return [chain.feature(f) for f in ["bias", *path_features(block.path), *text_features(text_key(block))]]


# How pages name the article and what stands around it. The labels of training pages.
ARTICLE_FRAMES = (
    "article", "main", "main>article", "div content", "div main content", "div post", "div entry content", "div article body",
    "section story", "div post body", "article post", "div text", "td content", "main>section", "div container>article",
)
OTHER_FRAMES = (
    "nav", "nav>ul>li", "header", "header>div", "footer", "footer>p", "aside", "aside>p", "form", "form>p", "div ad", "div ads",
    "div advert", "div advertisement", "div banner", "div sponsor", "div sponsored", "div promo", "div promotion", "div sidebar",
    "div side", "div menu", "ul menu>li", "div nav", "div navigation", "div breadcrumb", "div breadcrumbs", "div cookie",
    "div cookies", "div consent", "div notice", "div alert", "div warning", "div related", "div share", "div social",
    "div comments", "div comments>p", "section comments>div comment", "div comment", "div comment>p", "ol comments>li", "div reply",
    "div replies", "div discussion", "div newsletter", "div subscribe", "div signup", "div login", "div pagination", "div pager",
    "div widget", "div popup", "div modal", "div footer", "div header", "div copyright", "div legal", "div disclaimer",
    "div tags", "div meta", "div byline", "div toolbar", "div search", "aside sidebar>ul>li", "select>option", "button",
)
# Names of what may also stand inside an article without being of it.
INSIDE_FRAMES = tuple(f for f in OTHER_FRAMES if f.split(">")[0] not in ("select", "button"))
ARTICLE_TAGS = ("p", "p", "p", "p", "h1", "h2", "h3", "li", "blockquote", "pre", "td", "figcaption", "dd", "div", "")


def relaid(texts: list[str], others: list[str], draw: np.random.Generator) -> list[tuple[Block, int]]:
    """A labelled page of the given article and side texts in a layout drawn at random."""

    def path(*frames: str) -> tuple[str, ...]:
        return ("html", "body", *(e for f in frames for e in f.split(">") if e))

    def side(at: str, inside: tuple[str, ...] = ()) -> list[tuple[Block, int]]:
        frame = draw.choice(INSIDE_FRAMES if inside else OTHER_FRAMES)
        own = draw.choice(["", "", "p", "ul>li", "div", "h3"]) if ">" not in frame else ""
        chosen = draw.choice(others, min(len(others), int(draw.integers(1, 5))))
        # Some side texts read like an article's: it is the names around them that tell.
        if draw.random() < 0.4 and texts:
            chosen = [str(t) for t in draw.choice(texts, 2)]
        return [(Block(str(t), path(*inside, frame, own), len(t) if draw.random() < 0.5 else 0), 0) for t in chosen]

    frame = tuple(draw.choice(ARTICLE_FRAMES).split(">"))
    outer = () if draw.random() < 0.7 else ("div page",)
    blocks = [b for _ in range(draw.integers(0, 4)) for b in side("top")]
    for i, text in enumerate(texts):
        tag = "h1" if i == 0 and draw.random() < 0.6 else draw.choice(ARTICLE_TAGS)
        nested = {"li": "ul>li", "td": "table>tr>td", "figcaption": "figure>figcaption", "dd": "dl>dd"}.get(tag, tag)
        linked = len(text) // 2 if draw.random() < 0.1 else 0
        if draw.random() < 0.3:
            text = " ".join(text.split()[: draw.integers(1, 6)])
            linked = 0
        for _ in range(draw.integers(1, 5) if nested != tag else 1):
            blocks.append((Block(text, path(*outer, *frame, nested), linked), 1))
        if draw.random() < 0.08:
            blocks += side("inside", (*outer, *frame))
    blocks += [b for _ in range(draw.integers(0, 5)) for b in side("end", (*outer, *frame) if draw.random() < 0.3 else ())]
    return blocks


# Elements with a name that declares the article, and what a page with one of them holds.
NAMED_FRAMES = tuple({e for f in ARTICLE_FRAMES for e in f.split(">") if " " in e and e != "div container"})
_NAMED = r"(class|id)\s*=\s*[\"']?[^\"'>]*(" + "|".join(sorted({w for e in NAMED_FRAMES for w in e.split()[1:]})) + ")"


def _declares(tag: str, names: set[str]) -> bool:
    return any(tag == f.split()[0] and names.issuperset(f.split()[1:]) for f in NAMED_FRAMES)


def labelled(pages: Iterable[str], seed: int = 7, named: bool = False) -> Iterator[list[tuple[Block, int]]]:
    """Training pages: corpus pages that mark their article by an element, or by a declared name, as they are and in other layouts."""
    draw = np.random.default_rng(seed)
    bad = frozenset("nav header footer aside form".split())
    for page in pages:
        blocks = leaf_blocks(page)
        tags = []
        for block in blocks:
            elements = [e.partition(" ") for e in block.path]
            names = {w for _, _, classes in elements for w in _WORDS.findall(classes)}
            marked = any(e[0] in ("article", "main") or (named and _declares(e[0], {*_WORDS.findall(e[2])})) for e in elements)
            other = any(e[0] in bad for e in elements) or any(f"div {w}" in OTHER_FRAMES for w in names)
            tags.append(int(marked and not other))
        if not any(tags) or all(tags):
            continue
        yield list(zip(blocks, tags, strict=True))
        texts = [b.text for b, t in zip(blocks, tags, strict=True) if t]
        others = [b.text for b, t in zip(blocks, tags, strict=True) if not t]
        for _ in range(RELAID):
            yield relaid(texts, others, draw)


def fit(pages: Iterable[str], seed: int = 7, named: bool = False) -> chain.Chain | None:
    """A field from pages that mark their article; None if none does."""
    sequences, tags = [], []
    for blocks in labelled(pages, seed, named):
        features = [block_features(b) for b, _ in blocks]
        wide = max(map(len, features))
        sequences.append(np.array([f + [0] * (wide - len(f)) for f in features]))
        tags.append(np.array([t for _, t in blocks], np.int64))
    return chain.fit(sequences, tags, epochs=10, batch=64, seed=seed) if sequences else None


class Extractor:
    """A fitted field over pages; scores of paths and of kinds of text are remembered."""

    def __init__(self, model: chain.Chain):
        self.places = np.flatnonzero(np.any(model.weights != 0, axis=1))
        self.values = model.weights[self.places]
        self.start, self.moves = model.start, model.moves

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("places", "values", "start", "moves")}

    def __getattr__(self, name: str):
        if name == "model":
            weights = np.zeros((chain.WIDTH, len(self.start)))
            weights[self.places] = self.values
            self.model = chain.Chain(weights, self.start, self.moves)
        elif name == "path_score":
            told = lambda path: self.model.emission([chain.feature(f) for f in ["bias", *path_features(path)]])
            self.path_score = lru_cache(REMEMBERED)(told)
        elif name == "text_score":
            self.text_score = lru_cache(REMEMBERED)(lambda key: self.model.emission([chain.feature(f) for f in text_features(key)]))
        else:
            raise AttributeError(name)
        return self.__dict__[name]

    def extract(self, pages: list[str]) -> list[list[str]]:
        """The article's blocks of each page."""
        read = [leaf_blocks(p) for p in pages]
        scores = [np.array([self.path_score(b.path) + self.text_score(text_key(b)) for b in blocks]).reshape(-1, 2) for blocks in read]
        paths = chain.best_tags(self.model, scores)
        return [[b.text for b, tag in zip(blocks, path, strict=True) if tag] for blocks, path in zip(read, paths, strict=True)]


def learn(pages: DataFrame, sample: int = SAMPLE) -> Extractor | None:
    """Fit on the first `sample` pages, by a hash of their ids, that hold an article or main element; if none does, an element of a declared name."""
    for named, pattern in ((False, r"<(article|main)[\s>]"), (True, _NAMED)):
        marked = pick(pages, "page_id", "html").where(F.col("page_id").isNotNull() & F.lower("html").rlike(pattern))
        # The ids are chosen first, so that no page moves but those that are learnt from.
        chosen = marked.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
        rows = marked.join(F.broadcast(chosen.distinct()), "page_id").orderBy(F.xxhash64("page_id"), "page_id", "html").limit(sample)
        if model := fit([r["html"] for r in rows.toLocalIterator()], named=named):
            return Extractor(model)
    return None


def extract_text(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The article of each page: page_id, url, blocks array<string>.

    One row per row of `pages`, repeated rows alike; null keys stay null. Character references
    are decoded, white space inside a block is one space, blocks come in page order, none are
    dropped or cut. A null or empty page has no blocks, nor has any page if no page of the
    corpus marks an article to learn from, by an element or by one of the names in NAMED_FRAMES. Cut-off markup at a page's end is left out. Other
    columns are ignored; an empty table gives an empty table.
    """
    rows = pick(pages, "page_id", "url", "html").withColumn("html", F.coalesce(F.col("html"), F.lit("")))
    extractor = learn(pages, sample)
    if extractor is None:
        return rows.select("page_id", "url", F.expr("cast(array() as array<string>) AS blocks"))
    shared = pages.sparkSession.sparkContext.broadcast(extractor)

    def extracted(batch: pa.RecordBatch) -> pa.RecordBatch:
        blocks = pa.array(shared.value.extract(batch.column("html").to_pylist()), pa.list_(pa.string()))
        return pa.record_batch([batch.column("page_id"), batch.column("url"), blocks], ["page_id", "url", "blocks"])

    schema = f"page_id {kind_of(rows, 'page_id')}, url {kind_of(rows, 'url')}, blocks array<string>"
    return map_slices(rows, extracted, schema)
