"""Main text of web pages: a tree-structured graphical model over the document tree."""

from __future__ import annotations

import html
import random
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.llm.common import small_batches

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe noembed noframes xmp".split())
#: What is never text of a page.
UNSEEN = RAW | set("head noscript template svg math object select option button datalist canvas audio video".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: An open element that the start of another one ends, and what such an end does not go beyond.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
FENCES = set("ul ol dl table body html article section div main aside nav header footer form".split())

CHROME = set(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar banner footer foot bottom copyright legal sidebar side "
    "aside rail related recommended widget cookie cookies consent gdpr privacy notice alert popup modal overlay ad ads advert "
    "adverts advertisement adsense sponsor sponsored promo promotion share sharing social follow newsletter subscribe "
    "subscription signup login search form pagination pager pages tags toolbar skip hidden contentinfo complementary".split()
)
COMMENTS = set("comment comments reply replies respond discussion disqus feedback reviews".split())
CONTENT = set("article content main post entry story body text prose single hentry".split())

ELEMENT = [
    "element", "top", "nav", "header", "footer", "aside", "form", "article", "main", "section", "heading", "list", "table", "p",
    "chrome", "comments", "content",
]
LEAF = [
    "leaf", "in_p", "in_heading", "in_list", "in_cell", "in_other", "to_25", "to_80", "to_200", "longer", "no_link", "some_link",
    "mostly_link", "sentence", "copyright",
]
FEATURES = {name: i for i, name in enumerate(ELEMENT + LEAF)}


@dataclass
class Page:
    """Nodes of a page in document order: block elements and, as leaves, blocks of text."""

    parent: list[int] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    mark: list[str | None] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)

    def add(self, parent: int, names: list[str], text: str | None, mark: str | None, tag: str) -> int:
        self.parent.append(parent)
        self.features.append([FEATURES[n] for n in names])
        self.text.append(text)
        self.mark.append(mark)
        self.tag.append(tag)
        return len(self.parent) - 1


def element_features(tag: str, attributes: str) -> tuple[list[str], str | None]:
    names, mark, told = ["element"], None, []
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key in ("class", "id", "role", "itemprop", "aria-label"):
            told += WORD.findall(value)
        elif key in ("hidden", "aria-hidden") and value != "false" or key == "style" and "display:none" in value.replace(" ", ""):
            told.append("hidden")
        elif key == "data-kept":
            mark = value
    words = {w.lower() for w in told}
    names += [name for name, some in (("chrome", CHROME), ("comments", COMMENTS), ("content", CONTENT)) if words & some]
    if tag in ("body", "html"):
        names.append("top")
    elif tag in ("nav", "header", "footer", "aside", "form", "article", "main", "section", "p"):
        names.append(tag)
    elif re.fullmatch("h[1-6]", tag):
        names.append("heading")
    elif tag in ("ul", "ol", "li", "dl", "dt", "dd", "menu"):
        names.append("list")
    elif tag in ("table", "tbody", "tr", "td", "th", "thead"):
        names.append("table")
    return names, mark


def leaf_features(tag: str, text: str, linked: int) -> list[str]:
    where = "in_other"
    if tag in ("p", "blockquote", "pre"):
        where = "in_p"
    elif re.fullmatch("h[1-6]", tag):
        where = "in_heading"
    elif tag in ("li", "dt", "dd"):
        where = "in_list"
    elif tag in ("td", "th"):
        where = "in_cell"
    n = len(text)
    size = "to_25" if n <= 25 else "to_80" if n <= 80 else "to_200" if n <= 200 else "longer"
    link = "no_link" if not linked else "some_link" if linked < n / 2 else "mostly_link"
    names = ["leaf", where, size, link]
    if text[-1] in ".!?…:;\"”»":
        names.append("sentence")
    if text.startswith("©") or "copyright" in text[:40].lower():
        names.append("copyright")
    return names


def read_page(source: str) -> Page:
    """The tree of a page; broken markup is mended much as browsers do."""
    page = Page()
    root = page.add(-1, ["element", "top"], None, None, "html")
    # Open elements: tag, node of the block they are in, whether unseen, whether in a link; and by tag,
    # how deep they lie.
    stack = [("html", root, False, False)]
    depths: defaultdict[str, list[int]] = defaultdict(list)
    words: list[str] = []
    linked, at = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(words).split())
        if text:
            node = holder[0]
            page.add(node, leaf_features(page.tag[node], text, linked), text, None, "")
        words.clear()
        linked = 0

    holder = [root]

    def said(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1][2]:
            text = html.unescape(raw)
            words.append(text)
            if stack[-1][3]:
                linked += len(" ".join(text.split()))

    def close(depth: int) -> None:
        if any(s[0] in BLOCKS for s in stack[depth:]):
            flush()
        while len(stack) > depth:
            depths[stack.pop()[0]].pop()
        holder[0] = stack[-1][1]

    def deepest(tags: Iterable[str]) -> int:
        """How deep the innermost open element of these tags lies; 0 for none."""
        return max((depths[t][-1] for t in tags if depths[t]), default=0)

    while at < len(source):
        found = TAG.search(source, at)
        if not found:
            said(source[at:])
            break
        said(source[at : found.start()])
        at = found.end()
        slash, tag, attributes = found[1] or found[4], found[2] or found[5], found[3] or found[6] or ""
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            fences = set() if tag in BLOCKS else set(FENCES)
            if tag in ("p", "li"):
                fences |= {"table", "body"}
            depth = deepest([tag])
            if depth > deepest(fences - {tag}):
                close(depth)
            continue
        if tag in ENDS or tag in BLOCKS:
            ended = ENDS.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
            while (depth := deepest(ended)) > deepest(FENCES - ended):
                close(depth)
                if tag not in ("tr", "td", "th"):
                    break
        if tag == "br":
            said(" ")
        if tag in VOID:
            if tag in BLOCKS:
                flush()
            continue
        if tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
            at = end.end() if end else len(source)
            continue
        node, unseen, link = stack[-1][1:]
        if tag in ("html", "body"):
            page.features[root] = [FEATURES["element"], FEATURES["top"]]
        elif tag in BLOCKS:
            flush()
            names, mark = element_features(tag, attributes)
            node = page.add(node, names, None, mark, tag)
            holder[0] = node
        if attributes.endswith("/") and tag not in BLOCKS:
            continue
        depths[tag].append(len(stack))
        stack.append((tag, node, unseen or tag in UNSEEN, link or tag == "a"))
    flush()
    return page


@dataclass
class Forest:
    """Many pages' nodes, parents before children."""

    parent: np.ndarray
    leaf: np.ndarray
    levels: list[np.ndarray]
    rows: np.ndarray  # of each feature entry, its node
    columns: np.ndarray


def plant(pages: list[Page]) -> Forest:
    starts = np.cumsum([0] + [len(p.parent) for p in pages])
    parent = np.concatenate([np.array(p.parent) + (np.array(p.parent) >= 0) * s for p, s in zip(pages, starts)])
    parent = parent.astype(np.int64)
    leaf = np.array([t is not None for p in pages for t in p.text], bool)
    depth = np.zeros(len(parent), np.int64)
    for n, up in enumerate(parent.tolist()):
        if up >= 0:
            depth[n] = depth[up] + 1
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.cumsum(np.bincount(depth))[:-1])
    features = [f for p in pages for f in p.features]
    rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
    return Forest(parent, leaf, levels, rows, np.array([x for f in features for x in f], np.int64))


@dataclass
class TreeModel:
    """Weights of features for "content", and parent-child potentials by kind of child
    (element, text) and state of parent and child."""

    weights: np.ndarray
    potentials: np.ndarray


def marginals(model: TreeModel, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    """By sum-product, messages upward and then downward: the probability of "content" for each
    node, and of each pair of states for the edge above each node."""
    n = len(forest.parent)
    belief = np.zeros((n, 2))
    belief[:, 1] = np.bincount(forest.rows, weights=model.weights[forest.columns], minlength=n)
    potential = model.potentials[forest.leaf.astype(np.int64)]  # by node, parent's state, own state
    message = np.zeros((n, 2))
    for level in forest.levels[:0:-1]:
        message[level] = np.logaddexp.reduce(belief[level][:, None, :] + potential[level], axis=2)
        np.add.at(belief, forest.parent[level], message[level])
    outside, edges = np.zeros((n, 2)), np.zeros((n, 2, 2))
    for level in forest.levels[1:]:
        up = forest.parent[level]
        cavity = outside[up] + belief[up] - message[level]
        joint = cavity[:, :, None] + potential[level]
        outside[level] = np.logaddexp.reduce(joint, axis=1)
        joint = joint + belief[level][:, None, :]
        edges[level] = np.exp(joint - np.logaddexp.reduce(joint.reshape(-1, 4), axis=1)[:, None, None])
    whole = outside + belief
    return 1 / (1 + np.exp(np.clip(whole[:, 0] - whole[:, 1], -500, 500))), edges


def labels(page: Page) -> np.ndarray:
    """What the marks of a labelled page say: a leaf has that of the nearest marked element above; an
    element is content if most of its text is."""
    state: list[str] = []
    good, whole = np.zeros(len(page.parent)), np.zeros(len(page.parent))
    for n, up in enumerate(page.parent):
        state.append(page.mark[n] or (state[up] if up >= 0 else "0"))
        if page.text[n] is not None:
            whole[n] = len(page.text[n])
            good[n] = whole[n] * (state[n] == "1")
    for n in range(len(page.parent) - 1, 0, -1):
        good[page.parent[n]] += good[n]
        whole[page.parent[n]] += whole[n]
    return (good * 2 > whole).astype(np.int64)


def fit_pages(pages: list[Page], steps: int = 400, rate: float = 0.1, shrink: float = 1e-5) -> TreeModel:
    """Maximum likelihood of the labels given the pages: observed minus expected counts of features
    and state pairs, where the expectation comes from the marginals."""
    model = TreeModel(np.zeros(len(FEATURES)), np.zeros((2, 2, 2)))
    if not pages:
        return model
    forest, y = plant(pages), np.concatenate([labels(p) for p in pages])
    below = np.flatnonzero(forest.parent >= 0)
    kind = forest.leaf[below].astype(np.int64)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (kind, y[forest.parent[below]], y[below]), 1)
    values = np.zeros(len(FEATURES) + 8)
    mean, square = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        model = TreeModel(values[: len(FEATURES)], values[len(FEATURES) :].reshape(2, 2, 2))
        p, edges = marginals(model, forest)
        up = np.bincount(forest.columns, weights=(y - p)[forest.rows], minlength=len(FEATURES))
        expected = np.zeros((2, 2, 2))
        np.add.at(expected, kind, edges[below])
        slope = np.r_[up, (seen - expected).reshape(-1)] / len(y) - shrink * values
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        values = values + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return TreeModel(values[: len(FEATURES)].copy(), values[len(FEATURES) :].reshape(2, 2, 2).copy())


def page_texts(model: TreeModel, sources: list[str]) -> list[str]:
    """The blocks of each page that are more likely content than not, joined by spaces."""
    pages = [read_page(s) for s in sources]
    if not pages:
        return []
    p = marginals(model, plant(pages))[0]
    out, at = [], 0
    for page in pages:
        out.append(" ".join(t for t, q in zip(page.text, p[at : at + len(page.text)]) if t is not None and q > 0.5))
        at += len(page.text)
    return out


# What surrounds an article on the pages that training makes from others' texts.
WRAPS = (
    ("article", ""), ("main", ""), ("div", 'class="content"'), ("div", 'id="content"'), ("div", 'class="post-body"'),
    ("div", 'class="entry-content"'), ("section", 'class="story"'), ("div", 'class="article-text"'), ("div", ""),
    ("article", 'class="post"'), ("main", 'id="main"'), ("div", 'itemprop="articleBody"'),
)
PROSE_CHROME = (
    ("div", 'class="ad"'), ("div", 'class="advert"'), ("aside", ""), ("aside", 'class="sidebar"'), ("div", 'class="sidebar"'),
    ("footer", ""), ("div", 'class="footer"'), ("div", 'id="cookie-notice"'), ("div", 'class="notice"'), ("header", ""),
    ("div", 'class="promo sponsored"'), ("div", 'role="banner"'), ("form", 'class="newsletter"'), ("form", ""),
    ("div", 'class="popup"'), ("section", 'class="related"'),
)
LINK_CHROME = (
    ("nav", ""), ("div", 'class="menu"'), ("nav", 'class="breadcrumbs"'), ("div", 'class="share"'), ("aside", 'class="related"'),
    ("div", 'class="pagination"'), ("header", ""), ("footer", ""), ("div", 'id="nav"'),
)
COMMENT_CHROME = (
    ("section", 'id="comments"'), ("div", 'class="comments"'), ("ol", 'class="comment-list"'), ("div", 'class="reply"'),
    ("section", 'class="comments-area"'), ("div", 'class="discussion"'),
)


def other_page(rng: random.Random, blocks: list[str], others: list[str]) -> str:
    """A labelled page with other wrapping around the blocks of an article; ``others`` are texts that
    are not of it."""

    def some() -> str:
        words = rng.choice(others).split()
        n = rng.choice([3, 8, 20, 60])
        at = rng.randrange(max(1, len(words) - n))
        return html.escape(" ".join(words[at : at + n]))

    def box(kind: tuple[str, str], inner: str) -> str:
        return f'<{kind[0]} {kind[1]} data-kept="0">{inner}</{kind[0]}>'

    def chrome() -> str:
        draw = rng.random()
        if draw < 0.4:
            links = "".join(f'<li><a href="/{i}">{some()[:20]}</a></li>' for i in range(rng.randint(2, 8)))
            return box(rng.choice(LINK_CHROME), f"<ul>{links}</ul>")
        if draw < 0.8:
            inner = rng.choice([some(), f"<p>{some()}</p>", f"<h3>{some()[:30]}</h3><p>{some()}</p>", f"<p>{some()}</p><p>{some()}</p>"])
            return box(rng.choice(PROSE_CHROME), inner)
        said = "".join(rng.choice([f"<p>{some()}</p>", f"<div>{some()}</div>"]) for _ in range(rng.randint(1, 5)))
        return box(rng.choice(COMMENT_CHROME), said)

    inner = []
    for i, text in enumerate(blocks):
        tag = "h1" if i == 0 else rng.choices(["p", "h2", "blockquote", "li", "div", "pre"], [20, 1, 1, 1, 1, 1])[0]
        inner.append(f"<{tag}>{html.escape(text)}</{tag}>")
        if rng.random() < 0.08:
            inner.append(chrome())
    if rng.random() < 0.3:
        inner.append(chrome())
    wrap = rng.choice(WRAPS)
    body = f'<{wrap[0]} {wrap[1]} data-kept="1">{"".join(inner)}</{wrap[0]}>'
    before = "".join(chrome() for _ in range(rng.randint(1, 4)))
    after = "".join(chrome() for _ in range(rng.randint(1, 4)))
    if rng.random() < 0.3:
        return f"<html><body>{before}<div class='wrapper'>{body}{chrome()}</div>{after}</body></html>"
    return f"<html><body>{before}{body}{after}</body></html>"


def fit_on_table(pages: DataFrame, sample: int = 200, others: int = 3, longest: int = 100_000) -> TreeModel:
    """A model from at most ``sample`` pages of at most ``longest`` characters, drawn by a hash of the
    id among those that mark their article by an element of that name.

    Each also enters with other wrapping, ``others`` times. Where no page marks its article, the model
    is fitted on made-up pages only: the longer text blocks of as many pages stand for an article,
    within the wrapping and chrome that ``other_page`` makes of the shorter ones. Pages without any
    text, or no pages, give weights of 0, and then no page has a main text.
    """
    short = pages.where(F.length("html") <= longest)
    order = F.xxhash64("page_id"), F.xxhash64("html")
    rows = short.where(F.lower("html").contains("<article")).select("html").orderBy(*order).limit(sample).collect()
    if not rows:
        return _fit_unmarked([r[0] for r in short.select("html").orderBy(*order).limit(sample).collect()], others)
    marked = [re.sub(r"<article\b", '<article data-kept="1"', r[0], flags=re.IGNORECASE) for r in rows]
    trees = [read_page(m) for m in marked]
    blocks = [[t for t, y in zip(p.text, labels(p)) if t is not None and y] for p in trees]
    rest = [t for p in trees for t, y in zip(p.text, labels(p)) if t is not None and not y]
    rest += [t for b in blocks for t in b[1:3]]
    rng = random.Random(20240607)
    made = [read_page(other_page(rng, b, rest)) for b in blocks if b and rest for _ in range(others)]
    return fit_pages([t for t, b in zip(trees, blocks) if b] + made)


def _fit_unmarked(sources: list[str], others: int, words: int = 8) -> TreeModel:
    """A model from made-up pages with the text blocks of these: those of at least so many words
    are taken for an article's."""
    texts = [[t for t in read_page(s).text if t is not None] for s in sources]
    blocks = [[t for t in some if len(t.split()) >= words] for some in texts]
    rest = [t for some in texts for t in some if len(t.split()) < words] or [t for some in blocks for t in some]
    rng = random.Random(20240607)
    return fit_pages([read_page(other_page(rng, b, rest)) for b in blocks if b for _ in range(others)])


def extract_main_text(pages: DataFrame, model: TreeModel) -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars.

    Blocks of text and the elements around them are a tree; each node is content or not. Parent-child
    potentials and features of the nodes make the model; sum-product messages give each block's
    probability, and those above one half are joined by a space in page order, with white space
    inside a block as one space and character references decoded.

    A null html is empty; a page without content has an empty text. Null ids and urls stay; repeated
    rows are read each; other columns are dropped.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, 1 << 20):
                texts = page_texts(model, part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    read = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return read.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
