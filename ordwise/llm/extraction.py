"""Main text of web pages by a tree-structured graphical model.

Every DOM node (elements and runs of text) is a variable that is content or not.
Potentials: one per node from its observed features, one per parent and child
from how often content follows content and how often it begins or ends there.
Messages are summed upward from the leaves and downward from the root, which on
a tree gives exact marginals; text whose marginal is over one half is kept.
The potentials are counted on labelled pages: those that mark their article
with a landmark element. Fixed prior counts stand for what no labelled page shows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise.llm.common import small_batches, tidy

#: Bound of the labelled pages the potentials are counted on: the smallest hashes of page_id.
MAX_LABELLED = 2_000
#: Pages of one message-passing batch, in bytes of html.
BATCH_BYTES = 2 << 20

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head script style template noscript title svg math iframe object canvas audio video".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
             "strike strong sub sup time tt u var br wbr img".split())
#: An opening tag ends an open element of its kind, searched up to the given limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_STOP = {"article", "section", "main", "div", "body", "html", "table", "td", "th", "nav", "aside", "footer",
         "header", "form", "blockquote", "li", "ul", "ol"}

#: Landmarks: tags, roles and words of class or id names that speak for or against content.
FOR_TAGS = {"article", "main"}
AGAINST_TAGS = {"nav", "aside", "footer", "header", "button", "select", "textarea", "input", "menu",
                "dialog", "fieldset", "address"}
FOR_ROLES = {"main", "article"}
AGAINST_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog",
                 "menu", "menubar", "alertdialog", "toolbar", "status", "note"}
FOR_WORDS = set("article articlebody content main mainbody post entry story body text maincontent maintext "
                "storybody postbody entrycontent prose".split())
AGAINST_WORDS = set("ad ads advert adverts advertisement advertising adsense adslot banner promo promotion "
                    "sponsor sponsored sponsors sidebar side rail nav navbar navigation menu submenu breadcrumb "
                    "breadcrumbs footer foot header masthead topbar comment comments commentlist disqus reply "
                    "replies respond reactions discussion cookie cookies consent gdpr notice notices alert popup "
                    "modal overlay newsletter subscribe subscription signup share sharing social related "
                    "recommended recommendations widget toolbar pagination pager login search form skip "
                    "copyright legal disclaimer paywall teaser promoted outbrain taboola".split())

#: Of these, the words that also name parts of a story. Inside a landmark they are evidence only, and
#: how much is counted on the labelled pages: how often elements of this name lie in the article.
UNSURE_WORDS = sorted("side rail foot form search alert social related discussion reactions legal widget skip "
                      "login notice notices".split())
#: Prior (content, other) counts of such a name.
PRIOR_NAME = (2.0, 8.0)

#: Class names of an article element that holds a reader's comment, if another article does not.
COMMENT_NAMES = {"comment", "comments", "reply", "replies"}

#: With one of these a name tells of the layout ("has-sidebar"), not of the element itself.
LAYOUT_WORDS = {"has", "with", "no", "by", "page", "layout", "wrapper", "container"}

#: Groups of an observation; a value is an index into one list of counts.
KINDS = ["element", "landmark_for", "word_for", "against", "hidden", "text", "form", "unsure"]
ELEMENT, FOR, WORD_FOR, AGAINST, HIDE, TEXT, FORM, UNSURE = range(len(KINDS))
#: Nothing in these is main text, through any number of plain elements, unless a landmark opens below
#: them. (A form is none of them: it may wrap the whole page.)
SHUT = (AGAINST, HIDE)
#: Prior (content, other) counts of a node kind, and of a child's state by its kind and its parent's state.
#: (Landmarks outweigh any number of texts below them; a name's word only some.)
PRIOR_KIND = {ELEMENT: (4.0, 4.0), FOR: (1e60, 1.0), WORD_FOR: (30.0, 3.0), AGAINST: (1e-200, 1e3),
              HIDE: (1e-290, 1e6), TEXT: (4.0, 4.0), FORM: (1e-200, 1e3), UNSURE: (4.0, 4.0)}
PRIOR_STEP = {  # kind: ((other->other, other->content), (content->other, content->content))
    ELEMENT: ((40.0, 2.0), (1.0, 60.0)), FOR: ((5.0, 20.0), (1.0, 60.0)), WORD_FOR: ((5.0, 10.0), (1.0, 60.0)),
    AGAINST: ((60.0, 0.5), (5.0, 5.0)), HIDE: ((60.0, 0.5), (5.0, 5.0)), TEXT: ((40.0, 1.0), (0.5, 80.0)),
    FORM: ((60.0, 0.5), (5.0, 5.0)), UNSURE: ((60.0, 0.5), (5.0, 5.0)),
}
#: Text features: (length class, inside a link, block tag class, ends like a sentence).
LENGTHS, BLOCKS = 12, 4
N_TEXT = LENGTHS * 2 * BLOCKS * 2
TEXT_PRIOR = 2.0
#: A text's own features move its log odds by this much at most: landmarks decide first.
TEXT_LIMIT = 1.5

_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")
#: A character reference with more digits than Python turns into a number; 8 are out of range as well.
_LONG_REFERENCE = re.compile(r"&#(?=[0-9]{4000})0*([0-9]*)")


def _name_words(value: str) -> list[str]:
    words = [w.lower() for w in _NAME.findall(value)]
    return words + [a + b for a, b in zip(words, words[1:])]


def unsure_word(attrs: dict) -> int:
    """Place in ``UNSURE_WORDS`` of a name's first such word, -1 if it has none or a plainer one."""
    words = _name_words(f"{attrs.get('class') or ''} {attrs.get('id') or ''}") if attrs else []
    against = [w for w in words if w in AGAINST_WORDS]
    if not against or not set(against) <= set(UNSURE_WORDS):
        return -1
    return UNSURE_WORDS.index(against[0])


def _element_kind(tag: str, attrs: dict) -> int:
    if tag in HIDDEN or "hidden" in attrs or attrs.get("aria-hidden") == "true" \
            or "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
        return HIDE
    role = (attrs.get("role") or "").lower()
    if tag in AGAINST_TAGS or role in AGAINST_ROLES:
        return AGAINST
    if tag in INLINE:       # a name inside a line of text marks no part of the page
        return ELEMENT
    if tag == "form":
        return FORM
    if tag in FOR_TAGS or role in FOR_ROLES or attrs.get("itemprop") == "articleBody":
        return FOR          # whatever its names say: they may be slugs of a category or tag
    words = _name_words(f"{attrs.get('class') or ''} {attrs.get('id') or ''}") if attrs else []
    if tag not in ("body", "html") and LAYOUT_WORDS.isdisjoint(words) and any(w in AGAINST_WORDS for w in words):
        return AGAINST
    if tag not in ("body", "html") and any(w in FOR_WORDS for w in words):
        return WORD_FOR
    return ELEMENT


class _Tree(HTMLParser):
    """Nodes of one page in page order: parent, kind, and for text the block it belongs to."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.kind, self.tag, self.depth = [-1], [ELEMENT], ["#page"], [0]
        self.names: list[tuple[int, int]] = []                 # (node, place in UNSURE_WORDS)
        self.texts: list[tuple[int, int, bool, str]] = []      # (node, block, in a link, text)
        self.comments: list[int] = []                          # articles named as a reader's comment
        self.muted: list[int] = []                             # landmarks below comments, menus and the like
        self.open = [0]
        self.mark: list[int | None] = [None]                   # per open element: the innermost such kind
        self.at: dict[str, list[int]] = {}                     # places of a tag's elements in ``open``
        self.block = 0
        self.blocks = ["#page"]

    def _node(self, tag: str, kind: int) -> int:
        self.parent.append(self.open[-1])
        self.kind.append(kind)
        self.tag.append(tag)
        self.depth.append(self.depth[self.open[-1]] + 1)
        return len(self.parent) - 1

    def _last(self, names) -> int:
        """The innermost open element of these names, as a place in ``open``; 0 if there is none."""
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=0)

    def _close_from(self, place: int) -> None:
        for node in self.open[place:]:
            self.at[self.tag[node]].pop()
        del self.open[place:], self.mark[place:]

    def _new_block(self, tag: str) -> None:
        self.block += 1
        self.blocks.append(tag)

    def _close_one(self, names: set, limits: set) -> None:
        place = self._last(names)
        if place > self._last(limits):
            self._close_from(place)

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self._close_one({"p"}, _STOP)
            if tag in CLOSES:
                self._close_one(*CLOSES[tag])
            if tag == "body":
                self._close_one({"head"}, set())
            self._new_block(tag)
        if tag in VOID:
            if tag == "br":       # white space inside its block
                self.handle_data(" ")
            return
        kind = _element_kind(tag, dict(attrs)) if attrs or tag not in INLINE else ELEMENT
        muted = False
        if kind in (FOR, WORD_FOR):
            above = self._above()
            is_main = tag == "main" or (dict(attrs).get("role") or "").lower() == "main"
            if above == HIDE or above == AGAINST and not (kind == FOR and is_main):
                muted = kind == FOR and above == AGAINST
                kind = ELEMENT      # a landmark below comments, menus and the like marks no main text
        word = unsure_word(dict(attrs)) if kind == AGAINST and tag not in AGAINST_TAGS \
            and (dict(attrs).get("role") or "").lower() not in AGAINST_ROLES else -1
        if word >= 0 and self._above(FOR) == FOR:
            kind = UNSURE
        node = self._node(tag, kind)
        if word >= 0:
            self.names.append((node, word))
        self.mark.append(kind if kind in (FOR, *SHUT) else self.mark[-1])
        if muted:
            self.muted.append(node)
        if tag == "article" and kind == FOR and not COMMENT_NAMES.isdisjoint((dict(attrs).get("class") or "").lower().split()):
            self.comments.append(node)
        self.at.setdefault(tag, []).append(len(self.open))
        self.open.append(node)

    def _above(self, none: int | None = None) -> int | None:
        """The innermost open landmark or element against content; on a page without: ``none``."""
        return FOR if self.mark[-1] is None and none is None else self.mark[-1]

    def parse_marked_section(self, i, report=1):
        """As in browsers, any <![...> is a comment up to the next >, whatever its name."""
        return self.parse_bogus_comment(i, report)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        self._close_one({tag}, _STOP - {tag} if tag in INLINE or tag == "p" else set())
        if tag not in INLINE:
            self._new_block(self.tag[self.open[-1]])

    def handle_data(self, data):
        if not data:
            return
        if data.isspace():
            # keeps words apart; has no state of its own
            self.texts.append((-1, self.block, False, " "))
            return
        link = bool(self.at.get("a"))
        self.texts.append((self._node("#text", TEXT), self.block, link, data))


_BLOCK_CLASS = {"p": 1, "li": 2, "td": 2, "th": 2, "dt": 2, "dd": 2,
                **{t: 3 for t in ("h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption")}}


def _comments_beside_articles(tree: _Tree) -> None:
    """Articles named as comments speak against content on a page with an article that is not;
    elsewhere ("comment" may be the section of the paper) they are the main text."""
    others = sum(t == "article" and k == FOR for t, k in zip(tree.tag, tree.kind)) - len(tree.comments)
    if not tree.comments or others <= 0:
        return
    below = set(tree.comments)
    for i in range(tree.comments[0], len(tree.parent)):
        if tree.parent[i] in below:
            below.add(i)
            if tree.kind[i] in (FOR, WORD_FOR):
                tree.kind[i] = ELEMENT
    for i in tree.comments:
        tree.kind[i] = AGAINST


def _article_in_a_wrapper(tree: _Tree) -> None:
    """A page's only landmark counts below an element that speaks against content if it holds
    more than half of the text: then that element wraps the page."""
    if len(tree.muted) != 1 or any(k in (FOR, WORD_FOR) for k in tree.kind):
        return
    mark, inside, hidden = tree.muted[0], set(), set()
    for i in range(len(tree.parent)):
        if tree.kind[i] == HIDE or tree.parent[i] in hidden:
            hidden.add(i)
        elif i == mark or tree.parent[i] in inside:
            inside.add(i)
    sizes = [(node, len(text)) for node, _, _, text in tree.texts if node >= 0 and node not in hidden]
    if 2 * sum(n for i, n in sizes if i in inside) > sum(n for _, n in sizes):
        tree.kind[mark] = FOR


def parse(html: str) -> _Tree:
    """The node tree of the whole page."""
    tree = _Tree()
    tree.feed(_LONG_REFERENCE.sub(lambda m: "&#" + (m[1][:8] or "0"), html))
    tree.close()
    _comments_beside_articles(tree)
    _article_in_a_wrapper(tree)
    return tree


def _text_features(tree: _Tree) -> np.ndarray:
    out = np.zeros(len(tree.parent), np.int64)
    for node, block, link, text in tree.texts:
        if node >= 0:
            size = min(LENGTHS - 1, len(text.strip()).bit_length())
            ends = text.rstrip()[-1:] in (".", "!", "?", "…")
            kind = _BLOCK_CLASS.get(tree.blocks[block], 0)
            out[node] = ((size * 2 + link) * BLOCKS + kind) * 2 + ends
    return out


@dataclass
class Potentials:
    """log odds of a node kind, of text features, of unsure names, and log steps[kind, parent state, own state]."""
    kind: np.ndarray
    text: np.ndarray
    steps: np.ndarray
    name: np.ndarray

    def marginals(self, forest: Forest) -> np.ndarray:
        """Content probability of every node of a forest (parents come before children).

        Time is linear in the nodes: a level costs what it holds. Levels of few nodes, as
        deep nesting makes them, are not worth an array and go node by node.
        """
        parent, kind, depth = forest.parent, forest.kind, forest.depth
        n = len(parent)
        own = np.zeros((n, 2))
        own[:, 1] = np.where(kind == TEXT, self.text[forest.text], self.kind[kind])
        named = (kind == UNSURE) & (forest.word >= 0)
        own[named, 1] += self.name[forest.word[named]]
        if n and depth.max() > DEEP:
            return self._node_by_node(parent, kind, own)
        order = np.argsort(depth, kind="stable")
        ends = np.searchsorted(depth[order], np.arange(depth.max(initial=0) + 2))
        shut = np.isin(kind, SHUT)
        for d in range(1, len(ends) - 1):        # what is below a shut element is shut, too
            v = order[ends[d]:ends[d + 1]]
            shut[v] |= shut[parent[v]] & (kind[v] != FOR)
        own[shut, 1] = -np.inf
        below = own.copy()                       # own potential and all messages from below
        up = np.zeros((n, 2))
        steps = self.steps[kind]
        for d in range(len(ends) - 2, 0, -1):    # upward
            v = order[ends[d]:ends[d + 1]]
            up[v] = np.logaddexp(steps[v, :, 0] + below[v, 0, None], steps[v, :, 1] + below[v, 1, None])
            for s in (0, 1):
                np.add.at(below[:, s], parent[v], up[v, s])
        full = below.copy()                      # and the message from above
        for d in range(1, len(ends) - 1):        # downward
            v = order[ends[d]:ends[d + 1]]
            rest = full[parent[v]] - up[v]
            full[v] += np.logaddexp(steps[v, 0, :] + rest[:, 0, None], steps[v, 1, :] + rest[:, 1, None])
        return 1 / (1 + np.exp(np.clip(full[:, 0] - full[:, 1], -700, 700)))

    def _node_by_node(self, parent, kind, own) -> np.ndarray:
        """The same messages, one node after the other."""
        from math import exp, inf, log1p

        def add(a, b):
            if a < b:
                a, b = b, a
            return a if b == -inf else a + log1p(exp(b - a))

        parent, kinds, steps = parent.tolist(), kind.tolist(), self.steps.tolist()
        n, odds = len(parent), own[:, 1].tolist()
        shut = [False] * n
        for i in range(n):
            up = parent[i]
            shut[i] = kinds[i] in SHUT or up >= 0 and shut[up] and kinds[i] != FOR
        below = [[0.0, -inf if shut[i] else odds[i]] for i in range(n)]
        message = [(0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):
            if parent[i] >= 0:
                (a, b), (c, d), (x, y) = *steps[kinds[i]], below[i]
                message[i] = m = add(a + x, b + y), add(c + x, d + y)
                up = below[parent[i]]
                up[0] += m[0]
                up[1] += m[1]
        for i in range(n):
            if parent[i] >= 0:
                (a, b), (c, d), up, m = *steps[kinds[i]], below[parent[i]], message[i]
                x, y = up[0] - m[0], up[1] - m[1]
                below[i][0] += add(a + x, c + y)
                below[i][1] += add(b + x, d + y)
        gap = np.array([x - y for x, y in below])
        return 1 / (1 + np.exp(np.clip(np.nan_to_num(gap, nan=700.0), -700, 700)))


#: Trees deeper than this are read node by node.
DEEP = 400


@dataclass
class Forest:
    """The nodes of several trees: parent, kind, text feature, depth, place of an unsure name (or -1)."""
    parent: np.ndarray
    kind: np.ndarray
    text: np.ndarray
    depth: np.ndarray
    word: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, trees: list[_Tree]) -> Forest:
        sizes = [len(t.parent) for t in trees]
        first = np.cumsum(sizes) - sizes
        parent = np.concatenate([np.array(t.parent) + (f * (np.array(t.parent) >= 0)) for t, f in zip(trees, first)])
        word = np.full(len(parent), -1)
        for t, f in zip(trees, first):
            for node, place in t.names:
                word[f + node] = place
        return cls(parent, np.concatenate([np.array(t.kind) for t in trees]),
                   np.concatenate([_text_features(t) for t in trees]), np.concatenate([np.array(t.depth) for t in trees]),
                   word, first)


def labels_of(tree: _Tree) -> np.ndarray | None:
    """Content state of every node of a page that marks exactly one article; else None.

    Content is the landmark and what is below it, but not what is below an
    element that speaks against content.
    """
    marks = [i for i, (t, k) in enumerate(zip(tree.tag, tree.kind)) if t == "article" and k == FOR]
    if len(marks) != 1:
        marks = [i for i, (t, k) in enumerate(zip(tree.tag, tree.kind)) if t == "main" and k == FOR]
    if len(marks) != 1:
        return None
    state = np.zeros(len(tree.parent), np.int64)
    for i in range(1, len(state)):
        if i == marks[0]:
            state[i] = 1
        elif state[tree.parent[i]] and tree.kind[i] not in (*SHUT, FORM):
            state[i] = 1
    return state


_NAMES_AT = len(KINDS) * 2 + N_TEXT * 2 + len(KINDS) * 4
N_COUNTS = _NAMES_AT + len(UNSURE_WORDS) * 2


def count_labelled(trees: list[_Tree]) -> np.ndarray:
    """Counts of (kind, state), (text feature, state), (kind, parent state, state) and, for unsure
    names inside and outside of the article, (name, state)."""
    total = np.zeros(N_COUNTS)
    for t in trees:
        state = labels_of(t)
        if state is None:
            continue
        kind, text, parent = np.array(t.kind), _text_features(t), np.array(t.parent)
        total[:len(KINDS) * 2] += np.bincount(kind * 2 + state, minlength=len(KINDS) * 2)
        is_text = kind == TEXT
        at = len(KINDS) * 2
        total[at:at + N_TEXT * 2] += np.bincount(text[is_text] * 2 + state[is_text], minlength=N_TEXT * 2)
        total[at + N_TEXT * 2:_NAMES_AT] += np.bincount(kind[1:] * 4 + state[parent[1:]] * 2 + state[1:],
                                                        minlength=len(KINDS) * 4)
        for node, place in t.names:
            total[_NAMES_AT + place * 2 + state[node]] += 1
    return total


def potentials_from(counts: np.ndarray) -> Potentials:
    """Potentials from counts plus the prior counts; all zeros give the prior alone."""
    k = len(KINDS)
    kind = counts[:2 * k].reshape(k, 2) + np.array([PRIOR_KIND[i][::-1] for i in range(k)])
    by_kind = np.log(kind[:, 1]) - np.log(kind[:, 0])
    by_kind[[ELEMENT, TEXT, UNSURE]] = 0.0       # these kinds say nothing by themselves
    text = counts[2 * k:2 * k + 2 * N_TEXT].reshape(N_TEXT, 2)
    share = (text.sum(axis=0) + 1) / (text.sum() + 2)
    odds = np.log(text[:, 1] + TEXT_PRIOR * share[1]) - np.log(text[:, 0] + TEXT_PRIOR * share[0]) \
        - np.log(share[1] / share[0])
    steps = counts[2 * k + 2 * N_TEXT:_NAMES_AT].reshape(k, 2, 2) + np.array([PRIOR_STEP[i] for i in range(k)])
    names = counts[_NAMES_AT:].reshape(-1, 2) + PRIOR_NAME[::-1]
    return Potentials(by_kind, np.clip(odds, -TEXT_LIMIT, TEXT_LIMIT),
                      np.log(steps / steps.sum(axis=2, keepdims=True)), np.log(names[:, 1] / names[:, 0]))


def main_texts(htmls: list[str], model: Potentials) -> list[str]:
    """Main text of every page: kept text joined by block, white space inside a block as one
    space, trimmed, empty blocks left out, blocks joined by one line break."""
    trees = [parse(h) for h in htmls]
    if not trees:
        return []
    flat = [t for t in trees if max(t.depth) <= DEEP]       # one deep page must not slow the others
    keeps = {}
    for group in [flat] * bool(flat) + [[t] for t in trees if max(t.depth) > DEEP]:
        forest = Forest.of(group)
        keep = model.marginals(forest) > 0.5
        keeps.update({id(t): keep[f:f + len(t.parent)] for t, f in zip(group, forest.first)})
    out = []
    for tree in trees:
        keep = keeps[id(tree)]
        blocks: dict[int, list[str]] = {}
        for node, block, _, data in tree.texts:
            if node < 0:
                if block in blocks:
                    blocks[block].append(data)
            elif keep[node]:
                blocks.setdefault(block, []).append(data)
        lines = (_SPACE.sub(" ", "".join(parts)).strip() for _, parts in sorted(blocks.items()))
        out.append("\n".join(line for line in lines if line))
    return out


def _html(column: str = "html"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fit_potentials(pages: DataFrame, max_labelled: int = MAX_LABELLED) -> Potentials:
    """Potentials counted on at most ``max_labelled`` pages; only the counts leave the tasks."""
    chosen = (pages.filter("page_id is not null and html is not null").select("page_id").distinct()
              .orderBy(F.xxhash64("page_id"), "page_id").limit(max_labelled))
    src = pages.select("page_id", _html().alias("__html")).join(F.broadcast(chosen), "page_id").select("__html")

    def kernel(batches):
        import pyarrow as pa
        total = np.zeros(N_COUNTS)
        for b in small_batches(batches, "__html", BATCH_BYTES):
            total += count_labelled([parse(h) for h in b.column("__html").to_pylist()])
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["i", "n"])

    counts = np.zeros(N_COUNTS)
    for r in src.mapInArrow(tidy(kernel), "i long, n double").groupBy("i").agg(F.sum("n").alias("n")).collect():
        counts[r["i"]] = r["n"]
    return potentials_from(counts)


def extract(pages: DataFrame, model: Potentials) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    A null or empty html, or a page without content, gives an empty text; null ids
    and repeated rows are kept; an empty table gives no rows. Pages are
    read whole, and a page of any depth is handled without recursion.
    """
    src = pages.select("page_id", "url", _html().alias("__html"))
    schema = src.drop("__html").schema.add("text", "string").add("n_chars", "long")

    def kernel(batches):
        import pyarrow as pa
        for b in small_batches(batches, "__html", BATCH_BYTES):
            texts = main_texts(b.column("__html").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return src.mapInArrow(tidy(kernel), schema)


def extract_main_text(pages: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    return extract(pages, fit_potentials(pages, max_labelled))
