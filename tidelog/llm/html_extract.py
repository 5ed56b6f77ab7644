"""Main text of HTML pages by a linear-chain conditional random field over DOM leaf blocks.

A tolerant parser turns a page into leaf blocks: text under one block-level element, with the tags
and the class, id and role words of its ancestors. The field labels each block article or not;
features are those ancestors and the block's text (length, share of linked text, punctuation,
place), and neighbouring labels are tied by transition weights. It is trained here, on pages that
`labelled_pages` writes from templates (a documented, fixed number; menus, headers, footers,
sidebars, notices, adverts, forms and reader comments in many mark-ups), by gradient ascent on the
conditional likelihood with an L2 prior, and decoded by Viterbi. Each page is decoded on its own:
nothing is shuffled.

Text rules: scripts, styles, templates, comments, titles, drawings (svg), frames and the controls of
forms (button, select, textarea) are no text; what noscript, object and canvas hold is read like other
mark-up; character references are decoded; white space in a block becomes one space; blocks of the
article are joined in page order by one line break; nothing else is cut.

Defined cases: a null or empty page, or one without article blocks, gives an empty text; a self-closing
element holds nothing; an element of those that are no text drops its start tag only where it is never
closed, but a script or style that is never closed goes to the page's end, as does a comment; other
mark-up that is cut off or never closed is read as far as it goes; pages of any length are read whole;
repeated rows give repeated rows; an empty table gives an empty table; other columns are passed on,
result columns get leading underscores where names clash.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import bound_batches, free_name, text_slices

#: A comment, a tag (closing mark, name, attributes; a quote counts after an equals sign only), a declaration, or a tag that the page's end cuts off.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z""", re.S)
#: Elements whose content is no text of an article: scripts, styles, titles, drawings, frames and the controls of forms.
DROPPED = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in "script style template title textarea select button svg iframe".split()}
ATTRS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
#: Elements that begin and end blocks. Others are inline.
BLOCKS = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption header footer nav aside form fieldset legend label address details summary dialog center hr menu".split())
#: What an element's start tag closes when it is still open.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
STOPS = frozenset("ul ol dl table div section article main aside nav header footer form blockquote body html".split())
#: Start tags that leave a head open; others, and text, end it, as </head> may be left out.
HEADS = frozenset("html head title meta link base basefont bgsound script style noscript template".split())
#: Tags with a stray quote, which TOKEN does not read: no text of a head.
BROKEN = re.compile(r"</?[a-zA-Z][^<>]*>")
SPACE = re.compile(r"\s+")
WORDS = re.compile(r"[a-z]+")


def blocks(page: str) -> list[tuple[str, float, tuple[str, ...]]]:
    """(text, share of its characters in links, marks of its ancestors from the outermost) of each leaf block."""
    out: list[tuple[str, float, tuple[str, ...]]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, in_link, last = 0, 0, 0
    head = False

    def flush():
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", html_lib.unescape("".join(parts))).strip()
            if text:
                out.append((text, linked / max(1, sum(map(len, parts))), tuple(m for _, ms in stack for m in ms)))
            parts.clear()
        linked = 0

    def add(piece: str):
        nonlocal linked, head
        if piece and head:
            piece = BROKEN.sub("", piece)
            head = not piece.strip()
        if piece:
            parts.append(piece)
            linked += len(piece) if in_link else 0

    open_ended: set[str] = set()  # dropped elements that no later tag closes
    while m := TOKEN.search(page, last):
        add(page[last : m.start()])
        last = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        closing, attributes = m.group(1), m.group(3)
        if tag in DROPPED:
            if not closing and not attributes.rstrip().endswith("/") and tag not in open_ended:
                if end := DROPPED[tag].search(page, last):
                    last = end.end()
                else:
                    open_ended.add(tag)
                    last = len(page) if tag in ("script", "style") else last
            if head and tag not in HEADS:
                head = False
            continue
        if tag == "head":
            head = not closing
        elif not closing and tag not in HEADS:
            head = False
        if tag == "a":
            in_link = 0 if closing else 1
        elif tag in ("br", "img", "input", "wbr"):
            parts.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if closing:
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            in_link = 0
        elif tag != "hr" and not attributes.rstrip().endswith("/"):
            shut = CLOSES.get(tag, {"p"} if tag not in ("html", "body") else ())
            k = len(stack)
            while k and stack[k - 1][0] not in STOPS:
                k -= 1
                if stack[k][0] in shut:
                    del stack[k:]
                    k = len(stack)
            words = [w for a in ATTRS.findall(attributes) for w in WORDS.findall("".join(a).lower())] if attributes else []
            stack.append((tag, (f"<{tag}>", *(f".{w}" for w in words))))
    add(page[last:])
    flush()
    return out


def block_features(text: str, links: float, place: float) -> list[str]:
    n = len(text)
    return [
        f"len{min(9, n.bit_length())}", f"link{int(links * 4)}", f"place{int(place * 5)}", "end." if text[-1] in ".!?…。:;" else "end-", f"words{min(6, len(text.split()).bit_length())}",
        f"commas{min(3, text.count(','))}", "upper" if text[:1].isupper() else "lower", "mark" if any(c in text for c in "©|»›·") else "plain",
    ]


class Field:
    """Weights of features (by name), transitions (2 x 2) and the first label."""

    def __init__(self, names: list[str]):
        self.index = {f: i for i, f in enumerate(names)}
        self.w = np.zeros(len(names) + 1)
        self.trans, self.first = np.zeros((2, 2)), np.zeros(2)
        self.paths: dict[tuple[str, ...], float] = {}

    def scores(self, page: list[tuple[str, float, tuple[str, ...]]]) -> np.ndarray:
        """Score of label article over other, by block."""
        out = np.empty(len(page))
        for i, (text, links, path) in enumerate(page):
            s = self.paths.get(path)
            if s is None:
                if len(self.paths) > 50_000:
                    self.paths.clear()
                s = self.paths[path] = sum(self.w[self.index[f]] for f in set(path) | {"in" + (path[-1] if path else "")} if f in self.index) + self.w[-1]
            out[i] = s + sum(self.w[self.index[f]] for f in block_features(text, links, i / len(page)) if f in self.index)
        return out

    def decode(self, s: np.ndarray) -> np.ndarray:
        """Viterbi: the best labels."""
        back = np.zeros((len(s), 2), np.int8)
        a0, a1 = self.first[0], self.first[1] + s[0]
        t = self.trans
        for i in range(1, len(s)):
            back[i] = a1 + t[1, 0] > a0 + t[0, 0], a1 + t[1, 1] > a0 + t[0, 1]
            a0, a1 = max(a0 + t[0, 0], a1 + t[1, 0]), max(a0 + t[0, 1], a1 + t[1, 1]) + s[i]
        out = np.zeros(len(s), np.int8)
        out[-1] = a1 > a0
        for i in range(len(s) - 1, 0, -1):
            out[i - 1] = back[i, out[i]]
        return out

    def text(self, page: str | None) -> str:
        found = blocks(page) if page else []
        if not found:
            return ""
        return "\n".join(b[0] for b, y in zip(found, self.decode(self.scores(found)), strict=True) if y)


def _prose(r: random.Random, most: int) -> str:
    syll = "an de lo mi ra ti er on en st ca vu pe sol gri tan be no ru ek ash lin öf é mur".split()
    word = lambda: "".join(r.choice(syll) for _ in range(r.randint(1, 4)))
    return " ".join(" ".join(word() + ("," if r.random() < 0.1 else "") for _ in range(r.randint(1, 18))).rstrip(",").capitalize() + r.choice(".....!?") for _ in range(r.randint(1, most)))


def labelled_pages(n: int, seed: int = 5) -> list[str]:
    """Pages whose article blocks end in U+E000, in varied templates."""
    r = random.Random(seed)
    pages = []
    yes = "\ue000"
    pick = r.choice

    def short():
        return _prose(r, 1)[: r.randint(3, 40)]

    def menu():
        items = "".join(f'<li><a href="/{i}">{short()}</a></li>' for i in range(r.randint(2, 9)))
        return pick(['<nav><ul>{}</ul></nav>', '<div class="menu"><ul>{}</ul></div>', '<nav class="navbar" role="navigation"><ul class="nav">{}</ul></nav>', '<ul id="navigation">{}</ul>', '<div class="breadcrumb"><ul>{}</ul></div>', '<div class="top-menu topbar"><ul>{}</ul></div>']).format(items)

    def banner():
        return pick(['<header><h1>{a}</h1><p>{b}</p></header>', '<header class="site-header"><div class="logo"><a href="/">{a}</a></div></header>', '<div id="header"><p>{b}</p></div>', '<div class="masthead banner"><h2>{a}</h2></div>', '<header><p>{b}</p></header>', ""]).format(a=short(), b=_prose(r, 2))

    def foot():
        return pick(['<footer>&copy; {a} &middot; {b}</footer>', '<footer><p>{b}</p><ul><li><a href="/">{a}</a></li></ul></footer>', '<div id="footer"><p>{b}</p></div>', '<div class="site-footer"><p>{a}</p><p>{b}</p></div>', '<div class="copyright">{b}</div>']).format(a=short(), b=_prose(r, 2))

    def extra():
        k = r.randrange(9)
        t, u = _prose(r, r.randint(1, 6)), _prose(r, 2)
        if k == 0:
            return pick(['<div class="ad">{}</div>', '<div class="advert advertisement"><p>{}</p></div>', '<div id="sponsored"><p>{}</p></div>', '<div class="promo sponsor">{}</div>', '<aside class="ads"><p>{}</p></aside>', '<section class="ad banner-ad"><p>{}</p></section>']).format(t)
        if k == 1:
            return pick(['<aside><h3>{u}</h3><p>{t}</p></aside>', '<div class="sidebar"><p>{t}</p></div>', '<div id="sidebar"><h2>{u}</h2><ul><li><a href="/">{u}</a></li></ul><p>{t}</p></div>', '<aside class="widget"><p>{t}</p></aside>', '<div class="related"><h3>{u}</h3><ul><li><a href="/">{u}</a></li><li><a href="/">{u}</a></li></ul></div>']).format(t=t, u=u)
        if k == 2:
            return pick(['<div class="cookie-notice"><p>{}</p></div>', '<div id="cookie-banner">{}</div>', '<div class="notice"><p>{}</p></div>', '<div class="consent gdpr" role="dialog"><p>{}</p></div>', '<div class="alert message">{}</div>', '<div class="newsletter subscribe"><p>{}</p></div>', '<dialog><p>{}</p></dialog>']).format(t)
        if k == 3:
            return '<form action="/s"><label>{}</label><input name="q"><p>{}</p></form>'.format(short(), u)
        if k == 4:
            return pick(['<div class="share social"><ul><li><a href="/">{a}</a></li></ul></div>', '<div class="tags"><a href="/">{a}</a> <a href="/">{a}</a></div>', '<div class="pagination pager"><a href="/">{a}</a></div>', '<div class="byline meta"><p>{a}</p></div>']).format(a=short())
        return ""

    def comments():
        each = "".join(pick(['<div class="comment"><p>{}</p></div>', '<li class="comment"><b>{}</b><p>{}</p></li>', '<article class="comment"><p>{}</p></article>']).format(_prose(r, 3), _prose(r, 3)) for _ in range(r.randint(1, 5)))
        return pick(['<section id="comments"><h3>{a}</h3>{b}</section>', '<div class="comments">{b}</div>', '<div class="discussion responses" id="respond"><h2>{a}</h2>{b}</div>', '<section class="comment-list"><ol>{b}</ol></section>']).format(a=short(), b=each)

    for _ in range(n):
        parts = []
        if r.random() < 0.8:
            parts.append(f"<h1>{short()}{yes}</h1>")
        for _ in range(r.randint(1, 14)):
            x, t = r.random(), _prose(r, pick([1, 2, 6, 12]))
            if x < 0.68:
                parts.append(f"<p>{t}{yes}</p>")
            elif x < 0.74:
                parts.append(f"<p><b>{t}{yes}<br><p>{_prose(r, 5)}{yes}</p>")
            elif x < 0.8:
                parts.append(f"<{(h := pick(['h2', 'h3', 'h4']))}>{short()}{yes}</{h}>")
            elif x < 0.85:
                parts.append("<ul>" + "".join(f"<li>{_prose(r, 1)}{yes}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif x < 0.89:
                parts.append(f"<blockquote><p>{t}{yes}</p></blockquote>")
            elif x < 0.92:
                parts.append(f"<figure><figcaption>{short()}{yes}</figcaption></figure>")
            elif x < 0.95:
                parts.append(f"<table><tr><td>{short()}{yes}</td><td>{short()}{yes}</td></tr></table>")
            elif x < 0.97:
                parts.append(f'<p>{short()} <a href="/x">{short()}</a> {t}{yes}</p>')
            else:
                parts.append(f"<pre>{t}{yes}</pre>")
            if r.random() < 0.06:
                parts.append(extra())
        box = pick(['<article>{}</article>'] * 4 + ['<main><article>{}</article></main>', '<main>{}</main>', '<div class="content">{}</div>', '<div id="main"><div class="post entry">{}</div></div>', '<div class="article-body">{}</div>', '<section class="story text">{}</section>', '<article class="post"><div class="entry-content">{}</div></article>', '<main role="main"><div class="page">{}</div></main>', '<div itemprop="articleBody" class="body">{}</div>'])
        article = box.format("".join(parts)) if r.random() < 0.85 else box.format("".join(parts)).split("</p>")[0]
        before = [menu() if r.random() < 0.85 else "", banner(), extra(), extra() if r.random() < 0.5 else ""]
        after = [extra(), comments() if r.random() < 0.45 else "", extra() if r.random() < 0.4 else "", foot() if r.random() < 0.9 else ""]
        r.shuffle(before)
        before, after = ([] if r.random() < 0.12 else before), ([] if r.random() < 0.12 else after)
        pages.append(f"<!DOCTYPE html><html><head><title>{short()}</title><script>var t='</p>';</script></head><body>{''.join(before)}{article}{''.join(after)}</body></html>")
    return pages


@lru_cache(maxsize=2)
def trained(n_pages: int = 500, turns: int = 120, l2: float = 1.0, seed: int = 5) -> Field:
    """The field, fitted on n_pages labelled pages."""
    data = [[(t.rstrip("\ue000").rstrip(), k, p, t.endswith("\ue000")) for t, k, p in blocks(x)] for x in labelled_pages(n_pages, seed)]
    data = [[b for b in page if b[0]] for page in data]
    feats = [[sorted(set(p) | {"in" + (p[-1] if p else "")}) + block_features(t, k, i / len(page)) for i, (t, k, p, _) in enumerate(page)] for page in data]
    field = Field(sorted({f for page in feats for b in page for f in b}))
    d, most = len(field.w), max(map(len, feats))
    x = np.zeros((sum(map(len, feats)), d), np.float32)
    for row, b in enumerate(b for page in feats for b in page):
        x[row, [field.index[f] for f in b]] = 1
        x[row, -1] = 1
    lens = np.array([len(p) for p in data])
    at = np.full((len(data), most), -1)
    at[np.arange(most)[None, :] < lens[:, None]] = np.arange(len(x))
    live = at >= 0
    y = np.zeros(at.shape, int)
    y[live] = [b[3] for page in data for b in page]
    theta, m1, m2 = np.zeros(d + 6), np.zeros(d + 6), np.zeros(d + 6)
    rows = np.arange(len(data))
    for turn in range(1, turns + 1):
        w, t, f = theta[:d], theta[d : d + 4].reshape(2, 2), theta[d + 4 :]
        s = np.zeros((*at.shape, 2))
        s[live, 1] = x @ w
        a, b = np.zeros_like(s), np.zeros_like(s)
        a[:, 0] = s[:, 0] + f
        for i in range(1, most):
            a[:, i] = np.logaddexp(a[:, i - 1, 0:1] + t[0], a[:, i - 1, 1:2] + t[1]) + s[:, i]
        z = np.logaddexp(*a[rows, lens - 1].T)
        for i in range(most - 2, -1, -1):
            nxt = b[:, i + 1] + s[:, i + 1]
            b[:, i] = np.where(live[:, i + 1, None], np.logaddexp(t[:, 0] + nxt[:, 0:1], t[:, 1] + nxt[:, 1:2]), 0)
        p = np.exp(np.minimum(a + b - z[:, None, None], 0)) * live[..., None]
        g = np.zeros(d + 6)
        g[:d] = x.T @ (y[live] - p[live, 1])
        both = live[:, 1:]
        for i in (0, 1):
            for j in (0, 1):
                pair = np.exp(np.minimum(a[:, :-1, i] + t[i, j] + s[:, 1:, j] + b[:, 1:, j] - z[:, None], 0))
                g[d + 2 * i + j] = ((y[:, :-1] == i) & (y[:, 1:] == j) & both).sum() - (pair * both).sum()
            g[d + 4 + i] = (y[:, 0] == i).sum() - p[:, 0, i].sum()
        g -= l2 * theta
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        theta = theta + 0.15 * (m1 / (1 - 0.9**turn)) / (np.sqrt(m2 / (1 - 0.99**turn)) + 1e-6)
    field.w, field.trans, field.first = theta[:d], theta[d : d + 4].reshape(2, 2), theta[d + 4 :]
    return field


def extract(df: DataFrame, html: str = "html") -> DataFrame:
    """df's other columns, text and n_chars (code points)."""
    kept = [f for f in df.schema.fields if f.name != html]
    names = [f.name for f in kept]
    bound_batches(df.sparkSession)
    f = trained()
    shared = df.sparkSession.sparkContext.broadcast((list(f.index), f.w, f.trans, f.first))  # a fixed size

    def run(batches):
        names_, w, trans, first = shared.value
        field = Field(names_)
        field.w, field.trans, field.first = w, trans, first
        for part in text_slices(batches, 0, 4 << 20):
            texts = [field.text(x) for x in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[f"c{i}" for i in range(len(names) + 2)])

    types = T.StructType([T.StructField(f"c{i}", t) for i, t in enumerate([*(f.dataType for f in kept), T.StringType(), T.LongType()])])
    out = df.select(F.col(f"`{html}`").cast("string").alias("t"), *[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]).mapInArrow(run, types)
    return out.toDF(*names, free_name(names, "text"), free_name(names, "n_chars"))
