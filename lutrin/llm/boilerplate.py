"""HTML extraction with suffix arrays over the pages of a host.

Markup is cut into blocks. Blocks of an article are content; all others are the frame of the
page. The frames' token streams of one host are concatenated and their suffixes sorted; where
neighbours in that order share RUN tokens or more and come from enough different pages, the
substring is boilerplate of the host (`is_boilerplate`). Pages of equal content count once, so
copies of a page are no evidence, nor is a quote that two pages share. A page without an article keeps the tokens of its open blocks
that no such substring covers, and drops blocks that its markup names as frame.

The arrays are built over the pages of each host within a task, sorted as far as RUN tokens,
which is all that the decision needs. A task reports each substring once, with the number of
pages that have it, and Spark adds these up by host and substring, so a host with a third
of all pages is spread over all tasks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lutrin.llm import byte_words as bw
from lutrin.llm.common import Scratch
from lutrin.llm.html_blocks import ARTICLE, FRAME, OPEN, blocks
from lutrin.llm.language import host_of

#: Tokens that a repeated substring must have. A power of two.
RUN = 8
#: Boilerplate is on so many distinct pages of its host at least, and on this share of them.
LEAST_PAGES, SHARE = 3, 0.25

PARSED = "row long, page_id {key}, url string, host string, parts array<int>, texts array<string>"


def parse(batches):
    for batch in batches:
        parts, texts = [], []
        for page in batch.column(4):
            found = blocks(page.as_py() or "")
            parts.append([p for p, _ in found])
            texts.append([t for _, t in found])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(4)), pa.array(parts, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string()))],
            ["row", "page_id", "url", "host", "parts", "texts"],
        )


def frame_tokens(parts, texts):
    """Tokens of the blocks that are not the article, and of which block each is."""
    tokens, block = [], []
    for i, (part, text) in enumerate(zip(parts, texts)):
        if part != ARTICLE:
            words = text.split()
            tokens += words
            block += [i] * len(words)
    return tokens, block


def token_ids(tokens):
    data = np.frombuffer("".join(tokens).encode(), np.uint8)
    ends = np.cumsum([len(t.encode()) for t in tokens])
    return bw.hashes(data, np.concatenate([[0], ends[:-1]]), ends)


def suffix_order(ids, page):
    """Suffixes sorted by their first RUN tokens within their page.

    Returns (order, rank): positions in sorted order, and of every position the number of its
    prefix, equal for equal prefixes; -1 where fewer than RUN tokens follow in the page.
    Prefixes double: the rank of 2k tokens comes from two ranks of k tokens.
    """
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < RUN:
        later = np.full(n, -1, np.int64)
        later[: max(0, n - width)] = np.where(page[: n - width] == page[width:], rank[width:], -1)
        rank = np.where((rank >= 0) & (later >= 0), rank * (n + 1) + later, -1)
        rank = np.unique(rank, return_inverse=True)[1] - int((rank < 0).any())
        width *= 2
    return np.argsort(rank, kind="stable"), rank


def prefix_hash(ids, at):
    """64-bit hash of the RUN tokens from each position."""
    h = np.zeros(len(at), np.uint64)
    for k in range(RUN):
        h = bw.mix(h * np.uint64(0x9E3779B97F4A7C15) + ids[at + k])
    return h.view(np.int64)


def substrings(batches):
    """(host, substring, pages, opened, framed): every RUN tokens of a host's frames.

    With it come the number of pages that have it, how many of them have open blocks, and
    whether it stands in a part that markup names as frame.
    """
    streams = {}
    held = 0
    with np.errstate(over="ignore"):
        for batch in batches:
            for row, host, is_open, parts, texts in zip(*(batch.column(i).to_pylist() for i in range(5))):
                tokens, block = frame_tokens(parts, texts)
                if len(tokens) >= RUN:
                    sums = np.concatenate([[0], np.cumsum(np.array(parts)[block] == FRAME)])
                    framed = np.zeros(len(tokens), bool)
                    framed[: len(tokens) - RUN + 1] = sums[RUN:] - sums[:-RUN] == RUN
                    streams.setdefault(host, []).append((row, is_open, token_ids(tokens), framed))
                    held += len(tokens)
            if held > 1 << 22:
                yield from sorted_streams(streams)
                streams, held = {}, 0
        yield from sorted_streams(streams)


def sorted_streams(streams):
    for host, pages in streams.items():
        ids = np.concatenate([i for _, _, i, _ in pages])
        sizes = [len(i) for _, _, i, _ in pages]
        page = np.repeat([row for row, _, _, _ in pages], sizes)
        opened = np.repeat([is_open for _, is_open, _, _ in pages], sizes)
        framed = np.concatenate([f for _, _, _, f in pages])
        order, rank = suffix_order(ids, page)
        order = order[rank[order] >= 0]
        if not len(order):
            continue
        starts = np.concatenate([[True], rank[order][1:] != rank[order][:-1]])
        first = np.flatnonzero(starts)
        # equal prefixes stand in the order of their places, so a page's are neighbours
        turns = starts | np.concatenate([[True], page[order][1:] != page[order][:-1]])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([host] * len(first), pa.string()),
                pa.array(prefix_hash(ids, order[first])),
                pa.array(np.add.reduceat(turns.astype(np.int64), first)),
                pa.array(np.add.reduceat((turns & opened[order]).astype(np.int64), first)),
                pa.array(np.logical_or.reduceat(framed[order], first)),
            ],
            ["host", "substring", "pages", "opened", "framed"],
        )


def is_boilerplate():
    """Whether a substring is boilerplate of its host, from its counts and those of the host.

    It is on LEAST_PAGES distinct pages with open blocks and on SHARE of these; or markup names
    it as frame somewhere, and it is on two distinct pages and on SHARE of all.
    """
    usual = (F.col("opened") >= LEAST_PAGES) & (F.col("opened") >= SHARE * F.col("host_opened"))
    named = F.col("framed") & (F.col("pages") >= 2) & (F.col("pages") >= SHARE * F.col("host_pages"))
    return usual | named


def occurrences(batches):
    """(host, substring, row, at) of every RUN tokens that lie in pages with open blocks."""
    with np.errstate(over="ignore"):
        for batch in batches:
            out = [], [], [], []
            for row, host, parts, texts in zip(*(batch.column(i).to_pylist() for i in range(4))):
                tokens, _ = frame_tokens(parts, texts)
                if len(tokens) >= RUN:
                    at = np.arange(len(tokens) - RUN + 1)
                    out[0].extend([host] * len(at))
                    out[1].append(prefix_hash(token_ids(tokens), at))
                    out[2].extend([row] * len(at))
                    out[3].append(at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out[0], pa.string()),
                    pa.array(np.concatenate(out[1] or [np.zeros(0, np.int64)])),
                    pa.array(out[2], pa.int64()),
                    pa.array(np.concatenate(out[3] or [np.zeros(0, np.int64)]), pa.int32()),
                ],
                ["host", "substring", "row", "at"],
            )


def keep_unique(batches):
    """The text of pages with open blocks, without the tokens that boilerplate covers."""
    for batch in batches:
        page_id, url, parts, texts, covered = (batch.column(i) for i in range(5))
        out = []
        for p, t, c in zip(parts.to_pylist(), texts.to_pylist(), covered.to_pylist()):
            tokens, block = frame_tokens(p, t)
            gone = np.zeros(len(tokens) + RUN, bool)
            for k in range(RUN):
                gone[np.array(c or [], np.int64) + k] = True
            kept = [[] for _ in t]
            for word, i, dropped in zip(tokens, block, gone):
                if not dropped and p[i] == OPEN:
                    kept[i].append(word)
            out.append("\n".join(" ".join(words) for words in kept if words))
        yield pa.RecordBatch.from_arrays([page_id, url, pa.array(out, pa.string())], ["page_id", "url", "text"])


def main_text(pages, page_id="page_id", url="url", html="html"):
    """The main text of every page.

    One row per row of `pages`: page_id, url, text, blocks joined by a line feed and empty if
    there are none, n_chars. Null or empty html has no text; a null url makes pages of the
    empty host; null and repeated ids and repeated rows are carried as they are, and pages of
    equal content on a host are evidence of boilerplate only once; further columns are ignored; an empty table gives no rows. Pages of any length are parsed whole.
    """
    scratch = Scratch(pages.sparkSession, "boilerplate")
    whole = F.coalesce(F.col(html), F.lit(""))
    host = F.coalesce(host_of(F.col(url).cast("string")), F.lit(""))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"), whole.alias("html")
    )
    key = rows.schema["page_id"].dataType.simpleString()
    parsed = scratch.save(rows.mapInArrow(parse, PARSED.format(key=key)), "parsed", compression="zstd")
    is_open = F.array_contains("parts", OPEN)
    content = F.xxhash64("parts", "texts")  # pages of one host with equal blocks are copies of each other
    distinct = parsed.groupBy("host", content.alias("content"), is_open.alias("opened")).agg(F.min("row").alias("row"))
    distinct = scratch.save(distinct, "distinct")
    sizes = distinct.groupBy("host").agg(F.count("*").alias("host_pages"), F.count_if("opened").alias("host_opened"))
    frames = F.filter(F.arrays_zip("parts", "texts"), lambda b: b["parts"] != ARTICLE)
    frames = parsed.select("row", "host", is_open.alias("opened"), frames.alias("frames"))
    frames = frames.join(distinct.select("row"), "row", "left_semi").select("row", "host", "opened", "frames.parts", "frames.texts")
    runs = frames.mapInArrow(substrings, "host string, substring long, pages long, opened long, framed boolean").groupBy("host", "substring")
    runs = runs.agg(F.sum("pages").alias("pages"), F.sum("opened").alias("opened"), F.max("framed").alias("framed")).where("pages > 1")
    repeated = scratch.save(runs.join(sizes, "host").where(is_boilerplate()).select("host", "substring"), "repeated")
    places = parsed.where(is_open).select("row", "host", "parts", "texts").mapInArrow(occurrences, "host string, substring long, row long, at int")
    covered = places.join(repeated, ["host", "substring"]).groupBy("row").agg(F.collect_list("at").alias("covered"))
    opened = parsed.where(is_open).join(covered, "row", "left").select("page_id", "url", "parts", "texts", "covered")
    opened = opened.mapInArrow(keep_unique, f"page_id {key}, url string, text string")
    article = F.array_join(F.transform(F.filter(F.arrays_zip("parts", "texts"), lambda b: b["parts"] == ARTICLE), lambda b: b["texts"]), "\n")
    closed = parsed.where(~is_open).select("page_id", "url", article.alias("text"))
    return closed.union(opened).withColumn("n_chars", F.length("text").cast("long"))
