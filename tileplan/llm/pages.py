"""Main text of web pages: page structure first, then a host suffix array.

The structure gives the blocks of a page that may be main text, and whether they lie in its article. The token streams
of a host's pages are then put one after the other and their suffixes sorted by their first tokens; a run of sorted
suffixes that share MIN_TOKENS tokens is a long substring, and if it comes from a large share of the host's pages it is
boilerplate. Tokens that such substrings cover are removed and the unique runs stay.

In an article only what nearly every page of the host repeats is removed, since articles quote and copy each other;
blocks outside an article, used where a page has none, need a smaller share.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tileplan.llm.arrow import batch_of, slices, text_buffer
from tileplan.llm.tables import written
from tileplan.llm.words import STEP, Words, mix, powers

MIN_TOKENS = 8
MIN_PAGES = 10
ARTICLE_SHARE, LOOSE_SHARE = 0.9, 0.3
SHARD_PAGES = 512

BLOCKS = set("address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
             "h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
TRACKED = set("article aside button details dialog div fieldset figure footer form head header iframe main nav noscript "
              "ol section select svg table template textarea ul".split())
DROPPED = set("aside button dialog footer form head iframe nav noscript select svg template textarea".split())
# Words of class, id or role that mark what is no main text.
MARKS = set("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies footer "
            "masthead menu modal navbar nav navigation newsletter notice popup promo related share sidebar social "
            "sponsor sponsored subscribe toolbar".split())


class Reader(HTMLParser):
    """Blocks of one page: (in article, text), with white space in single spaces."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool]] = []  # tag, dropped, in article
        self.found: list[tuple[bool, str]] = []
        self.part: list[str] = []
        self.silent = 0

    def state(self) -> tuple[bool, bool]:
        return self.open[-1][1:] if self.open else (False, False)

    def end_block(self) -> None:
        text = " ".join("".join(self.part).split())
        self.part.clear()
        if text:
            self.found.append((self.state()[1], text))

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS or tag in TRACKED:
            self.end_block()
        elif tag == "br":
            self.part.append(" ")
        if tag in ("script", "style", "title"):
            self.silent += 1
        if tag in TRACKED:
            dropped, article = self.state()
            words = {w for name, value in attrs if name in ("class", "id", "role") and value
                     for w in value.lower().replace("-", " ").replace("_", " ").split()}
            gone = tag in DROPPED or (tag == "header" and not article) or bool(words & MARKS)
            self.open.append((tag, dropped or gone, article or tag in ("article", "main")))

    def handle_startendtag(self, tag, attrs):
        if tag == "br":
            self.part.append(" ")
        elif tag in BLOCKS:
            self.end_block()

    def handle_endtag(self, tag):
        if tag in BLOCKS or tag in TRACKED:
            self.end_block()
        if tag in ("script", "style", "title"):
            self.silent = max(0, self.silent - 1)
        if tag in TRACKED:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    del self.open[i:]
                    break

    def handle_data(self, data):
        if not self.silent and not self.state()[0]:
            self.part.append(data)


def blocks(html: str | None) -> tuple[bool, list[str]]:
    """(whether the page has an article, its blocks in order); without an article all blocks that are not dropped."""
    reader = Reader()
    reader.feed(html or "")
    reader.close()
    reader.end_block()
    article = any(a for a, _ in reader.found)
    return article, [t for a, t in reader.found if a or not article]


def _windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """(hash, page, first token) of all windows of MIN_TOKENS tokens; windows may cross blocks, not pages."""
    words = Words(*text_buffer(texts))
    tokens = words.hashes()
    n = len(tokens) - MIN_TOKENS + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), words
    factor, total = powers(STEP, MIN_TOKENS), np.zeros(n, np.uint64)
    for j in range(MIN_TOKENS):
        total += tokens[j:j + n] * factor[j]
    at = np.flatnonzero(words.text_of[:n] == words.text_of[MIN_TOKENS - 1:])
    return mix(total[at]), words.text_of[at], at, words


def suffix_order(ids: np.ndarray, pages: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of the token streams sorted by their first ``depth`` tokens (a power of 2), and the class of each: equal
    for equal beginnings. Ranks of twice the length come from pairs of ranks. A suffix ends with its page."""
    rank, n = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1, len(ids)
    step = 1
    while step < depth:
        after = np.zeros(n, np.int64)
        after[:max(n - step, 0)] = np.where(pages[step:] == pages[:max(n - step, 0)], rank[step:], 0)
        rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
        step *= 2
    return np.argsort(rank, kind="stable"), rank


def repeated_windows(host_pages: pa.Table) -> pa.Table:
    """Long substrings of one shard of a host's pages: hash of each run of MIN_TOKENS tokens found on two pages or
    more, and the number of those pages."""
    schema = pa.schema([("host", pa.string()), ("gram", pa.int64()), ("pages", pa.int64())])
    texts = host_pages.column("text").combine_chunks()
    grams, _, at, words = _windows(texts)
    if not len(grams):
        return schema.empty_table()
    order, rank = suffix_order(words.hashes(), words.text_of, MIN_TOKENS)
    whole = np.zeros(len(rank), bool)
    whole[at] = True
    order = order[whole[order]]  # suffixes with MIN_TOKENS tokens left
    group, page = rank[order], words.text_of[order]
    first = np.append(True, group[1:] != group[:-1])
    new_page = first | np.append(True, page[1:] != page[:-1])  # the sort is stable, so pages ascend in a group
    heads = np.flatnonzero(first)
    pages = np.add.reduceat(new_page.astype(np.int64), heads)
    name = np.zeros(len(rank), np.uint64)
    name[at] = grams
    often = pages >= 2
    host = host_pages.column("host")[0].as_py()
    return pa.table([pa.array([host] * int(often.sum()), pa.string()), name[order[heads[often]]].astype(np.int64),
                     pages[often]], schema=schema)


def uncovered(text: str, common: np.ndarray) -> str:
    """``text`` (blocks, one a line) without the tokens that common windows cover."""
    lines = text.split("\n")
    grams, _, at, words = _windows(pa.array([text]))
    hit = at[np.isin(grams, common)]
    if not len(hit):
        return text
    change = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + MIN_TOKENS, -1)
    keep = iter((np.cumsum(change)[:-1] == 0).tolist())
    left = (" ".join(w for w in line.split(" ") if next(keep)) for line in lines)
    return "\n".join(x for x in left if x)


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text and n_chars.

    A null html, or one without main text, gives an empty text; a null url is a host of its own; repeated rows are
    pages of their own; an empty table gives no rows.

    Pages are read and parsed twice, for the repeated substrings and for the result, so that their text is neither written
    nor shuffled more than once. The number of pages of a host and its common substrings are written: Spark knows their
    size then and broadcasts them if they are small. A host's shards are dealt one by one, whatever the join before.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("url", pa.string()), ("article", pa.bool_()), ("text", pa.string())])
        for batch in slices(batches, "html"):
            found = [blocks(h) for h in batch.column("html").to_pylist()]
            yield batch_of(schema, batch.column("key"), batch.column("url").cast(pa.string()), [a for a, _ in found],
                           ["\n".join(b) for _, b in found])

    raw = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    read = raw.mapInArrow(parse, "key LONG, url STRING, article BOOLEAN, text STRING").withColumn("host", host)
    counts = written(raw.select(host.alias("host")).groupBy("host").agg(F.count("*").alias("n")), "host-counts")
    shard = F.pmod(F.xxhash64("key", "url", "text"), F.ceil(F.col("n") / SHARD_PAGES)).cast("int")
    sharded = read.join(counts.where(F.col("n") >= MIN_PAGES), "host").withColumn("shard", shard)
    grams = (sharded.select("host", "shard", "text").repartition("host", "shard").groupBy("host", "shard").applyInArrow(
        lambda t: repeated_windows(t), "host STRING, gram LONG, pages LONG").groupBy("host", "gram").agg(
        F.sum("pages").alias("pages")))
    common = written(grams.join(counts, "host").withColumn("share", F.col("pages") / F.col("n"))
                     .where((F.col("pages") >= MIN_PAGES) & (F.col("share") >= LOOSE_SHARE))
                     .groupBy("host").agg(F.collect_list("gram").alias("loose"), F.collect_list(  # <= tokens of a page / share
                         F.when(F.col("share") >= ARTICLE_SHARE, F.col("gram"))).alias("strict")), "common-substrings")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
        for batch in slices(batches):
            grams = batch.column("common").to_pylist()
            texts = [uncovered(t, np.array(g, np.int64).astype(np.uint64)) if g else t
                     for t, g in zip(batch.column("text").to_pylist(), grams, strict=True)]
            yield batch_of(schema, batch.column("key"), batch.column("url"), texts, [len(t) for t in texts])

    return (read.join(common, "host", "left")
            .select("key", "url", "text", F.when(F.col("article"), F.col("strict")).otherwise(F.col("loose")).alias("common"))
            .mapInArrow(clean, "page_id LONG, url STRING, text STRING, n_chars LONG"))
