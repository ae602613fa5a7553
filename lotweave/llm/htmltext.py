"""Main text of web pages: structure first, and a host's repeated substrings where it says nothing.

A page is split into blocks, each marked by where it stands: inside an article or main element,
inside something that is no article (menus, headers, footers, sidebars, notices, adverts, forms,
reader comments, scripts, styles; by element, role, or words of class and id), or undecided.
A page with an article is that article's blocks, however often other pages repeat them: copies of
an article are articles.

For pages without one, the token streams of all blocks outside articles form the suffix array of
their host. Suffixes are cut at ``window`` tokens, so equal neighbours in sorted order are the
substrings of that length or longer that repeat; Spark groups them by host and cut suffix, adding
up distinct pages before the shuffle, so a large host is no large task. What at least
``min_pages`` different pages repeat is boilerplate: the tokens it covers are removed from
undecided blocks and the unique runs stay. A shorter block counts as a whole. Pages with the same
html are one page here.

Defined cases: null or empty html gives an empty text; unclosed elements end with the page, and an
article or main element ends the notice or menu around it that was not closed; repeated rows and
ids are extracted row by row; further columns are not carried.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotweave.session import ship_package

#: Elements, roles and words of class names that mark what is no article (fixed values).
NOISE_ELEMENTS = frozenset(
    "head nav header footer aside form script style noscript template button select textarea iframe svg canvas dialog menu object".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adverts sponsor sponsored promo promotion sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs topbar cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login "
    "comment comments disqus replies respond share sharing social related recommended widget pager pagination toolbar masthead "
    "searchbox alert banner copyright".split()
)
NOISE_NAMES = frozenset("header footer site-header site-footer page-header page-footer search form".split())
BLOCK_ELEMENTS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE, UNDECIDED, ARTICLE = 0, 1, 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|[^<]+|<", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = {name: re.compile(rf"</{name}\b", re.IGNORECASE) for name in ("script", "style", "textarea", "title", "noscript", "iframe")}


def _is_noise(name: str, attributes: str) -> bool:
    if name in NOISE_ELEMENTS:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            return True
        if key == "role" and value in NOISE_ROLES:
            return True
        if key in ("class", "id"):
            named = re.sub(r"\b(?:with|has|no|without)-[\w-]+", "", value)  # says what stands beside it
            if any(x in NOISE_NAMES for x in named.split()) or any(x in NOISE_WORDS for x in re.split(r"[^a-z0-9]+", named)):
                return True
    return False


def blocks(page: str) -> list[tuple[int, str]]:
    """(mark, text) of every block with text, in page order."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    parts: dict[int, list[str]] = {NOISE: [], UNDECIDED: [], ARTICLE: []}
    mark, at, articles = UNDECIDED, 0, 0

    def flush() -> None:
        for kind, held in parts.items():
            if held:
                text = " ".join(_html.unescape("".join(held)).split())
                if text:
                    out.append((kind, text))
                held.clear()

    while match := _TOKEN.match(page, at):
        at = match.end()
        name = match[2]
        if name is None:
            piece = match[0]
            if piece[0] != "<" or piece == "<":
                parts[mark].append(piece)
            continue
        name = name.lower()
        if name in BLOCK_ELEMENTS:
            flush()
        elif name == "br":
            parts[mark].append(" ")
        if match[1]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    mark = stack[depth][1]
                    del stack[depth:]
                    break
            continue
        if name in _RAW:
            end = _RAW[name].search(page, at)
            at = end.start() if end else len(page)
            stack.append((name, mark))
            continue
        if name in VOID_ELEMENTS or match[3].endswith("/"):
            continue
        stack.append((name, mark))
        if name in ("article", "main") and (mark != NOISE or not articles):
            mark, articles = ARTICLE, articles + 1
        elif mark != NOISE and _is_noise(name, match[3]):
            mark = NOISE
    flush()
    return out


def tokens(text: str) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in text.split(" ")], dtype=np.uint64)


def cut_suffixes(stream: np.ndarray, window: int) -> np.ndarray:
    """Hash of the first ``window`` tokens of each suffix; a shorter stream is one."""
    size = min(window, len(stream))
    out = np.zeros(len(stream) - size + 1, dtype=np.uint64)
    for k in range(size):
        out = (out ^ stream[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def _suffixes(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 512):
                part = batch.slice(a, 512)
                hosts, pages, keys = [], [], []
                for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if not page:
                        continue
                    own = [cut_suffixes(tokens(text), window) for mark, text in blocks(page) if mark != ARTICLE]
                    if own:
                        own = np.unique(np.concatenate(own))
                        hosts += [host] * len(own)
                        pages.append(np.full(len(own), xxhash.xxh64_intdigest(page), dtype=np.uint64))
                        keys.append(own)
                flat = lambda xs: pa.array((np.concatenate(xs) if xs else np.zeros(0, np.uint64)).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), flat(keys), flat(pages)], ["host", "suffix", "page"])

    return run


def _texts(names: list[str], loose: bool):
    """Pages with an article and their texts, or the undecided blocks of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 512):
                part = batch.slice(a, 512)
                keep, texts = [], []
                for i, page in enumerate(part.column(len(names)).to_pylist()):
                    found = blocks(page or "")
                    held = [text for mark, text in found if mark == ARTICLE]
                    rest = [text for mark, text in found if mark == UNDECIDED]
                    if loose and not held and rest:
                        keep.append(i), texts.append(rest)
                    elif not loose and (held or not rest):
                        keep.append(i), texts.append("\n".join(held))
                rows = part.select(list(range(len(names)))).take(pa.array(keep, pa.int64()))
                kind = pa.list_(pa.string()) if loose else pa.string()
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, kind)], [*names, "text"])

    return run


def _loose_suffixes(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, keys = [], []
            for i, texts in enumerate(batch.column(2).to_pylist()):
                own = np.unique(np.concatenate([cut_suffixes(tokens(t), window) for t in texts]))
                row += [i] * len(own)
                keys.append(own)
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            spots = batch.select([0, 1]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*spots.columns, pa.array(flat)], ["id", "host", "suffix"])

    return run


def unique_runs(text: str, window: int, repeated: set[int]) -> str:
    """The tokens that no repeated substring covers."""
    words = text.split(" ")
    covered = np.zeros(len(words), dtype=bool)
    size = min(window, len(words))
    for i, key in enumerate(cut_suffixes(tokens(text), window).view(np.int64).tolist()):
        if key in repeated:
            covered[i : i + size] = True
    return " ".join(w for w, c in zip(words, covered) if not c)


def _cut(names: list[str], window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for found, repeated in zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()):
                runs = [unique_runs(t, window, set(repeated or ())) for t in found]
                texts.append("\n".join(r for r in runs if r))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(texts, pa.string())], [*names, "text"])

    return run


def extract(pages: DataFrame, window: int = 8, min_pages: int = 3, key: str = "page_id") -> DataFrame:
    """(key, url, text, n_chars) for every row of ``pages``, which has ``key``, ``url`` and ``html``."""
    ship_package(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[^:/?#]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(key, "url", host.alias("host"), "html")
    names = [key, "url", "host"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)

    suffixes = rows.select("host", "html").mapInArrow(_suffixes(window), "host string, suffix long, page long")
    repeated = suffixes.groupBy("host", "suffix").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= min_pages)

    settled = rows.mapInArrow(_texts(names, loose=False), f"{fields}, text string")
    loose = rows.mapInArrow(_texts(names, loose=True), f"{fields}, text array<string>").withColumn("id", F.xxhash64("host", "text"))
    asked = (
        loose.select("id", "host", "text").dropDuplicates(["id"]).mapInArrow(_loose_suffixes(window), "id long, host string, suffix long")
    )
    hit = asked.join(repeated.select("host", "suffix"), ["host", "suffix"]).groupBy("id").agg(F.collect_list("suffix").alias("repeated"))
    cut = loose.join(hit, "id", "left").select(*names, "text", "repeated").mapInArrow(_cut(names, window), f"{fields}, text string")
    return settled.unionByName(cut).select(key, "url", "text", F.length("text").cast("long").alias("n_chars"))
