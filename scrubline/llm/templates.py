"""Main text of web pages by deducing the template of each host.

Tags (by their place in the page) and text blocks are tokens. Tokens with the same number of
occurrences on every page of a host form an equivalence class; a class is valid if its tokens come in
one order on all pages, and if its occurrences stay within one gap of the class above it. The valid
class of single tokens with the widest support is the template's root, the others are nested into its
gaps. What lies between the tokens of the root are slots. A slot, or its part inside articles, is main
text by what its blocks are over all pages of the host, and a page's text is what its main slots hold,
without text that belongs to the template and without elements that are marked as something else.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm import markup
from scrubline.llm.markup import CHROME, IN_ARTICLE, IN_MAIN
from scrubline.llm.tables import broadcast_if_small, map_slices
from scrubline.workspace import written

# A token is template material if it is on this share of a host's distinct pages, and on so many at least.
SUPPORT, FEWEST_PAGES = 0.5, 3
# Root classes have this many tokens at least.
FEWEST_TOKENS = 3
# A slot is no text if more than this share of its characters is marked or linked.
MOST_MARKED, MOST_LINKED = 0.5, 0.6
# Articles hold at least this share of a page's plain text, or they are not its frame.
LEAST_FRAMED = 0.5

TAG = 8


def _signed(key: int) -> int:
    return key - (1 << 63)


def with_host(pages: DataFrame) -> DataFrame:
    """Add ``host``: a hash of the URL's host, of an empty one where there is none."""
    url = F.coalesce(F.lower(F.col("url").cast("string")), F.lit(""))
    host = F.regexp_extract(url, "^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return pages.withColumn("host", F.xxhash64(host))


def tokenised(pages: DataFrame) -> DataFrame:
    """Every page read once: ``page_id``, ``url``, ``host`` and, in page order, what its tokens are.

    ``tokens`` are hashes, ``flags``, ``chars`` and ``links`` say what they are, and ``texts`` holds the
    text blocks that no mark excludes, null for other tokens. ``body`` is a hash of that text.
    """

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[] for _ in range(6)]
        for page in batch.column(3).to_pylist():
            lists = _lists(markup.read(page))
            for column, values in zip(out, lists, strict=False):
                column.append(values)
            whole = "\n".join(text for text in lists[4] if text is not None)
            out[5].append(_signed(xxhash.xxh3_64_intdigest(whole.encode("utf-8", "surrogatepass"))))
        kinds = [pa.list_(pa.int64())] + [pa.list_(pa.int32())] * 3 + [pa.list_(pa.string()), pa.int64()]
        columns = [batch.column(i) for i in range(3)] + [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "host", *_LISTS, "body"])

    rows = with_host(pages).select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), "host", F.col("html").cast("string")
    )
    schema = (
        "page_id long, url string, host long, tokens array<long>, flags array<int>, chars array<int>,"
        " links array<int>, texts array<string>, body long"
    )
    return map_slices(rows, rule, schema)


_LISTS = ["tokens", "flags", "chars", "links", "texts"]


def _lists(tokens: list[markup.Token]) -> tuple[list, ...]:
    """The columns of _LISTS for one page."""
    return (
        [_signed(t.key) for t in tokens],
        [t.flags | TAG * (t.text is None) for t in tokens],
        [len(t.text or "") for t in tokens],
        [t.link_chars for t in tokens],
        [None if t.flags & CHROME else t.text for t in tokens],
    )


def distinct_bodies(pages: DataFrame) -> DataFrame:
    """One page of each host and body, so that copies are no evidence of a template."""
    firsts = pages.groupBy("host", "body").agg(F.min(F.struct(F.xxhash64("tokens"), "page"))["page"].alias("page"))
    return pages.join(broadcast_if_small(written(firsts.select("page"), "bodies")), "page", "left_semi")


def equivalence_classes(pages: DataFrame) -> DataFrame:
    """``host``, ``class`` (its occurrence vector as a hash), ``support``, ``once``, ``tokens``.

    The vector of a token is folded into an exclusive-or over pages, so no vector is ever gathered.
    Classes with support on fewer pages than a template needs are left out, which also bounds the
    number of tokens: they all occur on one and the same page.
    """
    numbered = pages.select("host", "page", F.explode("tokens").alias("token"))
    counts = numbered.groupBy("host", "page", "token").agg(F.count("*").alias("n"))
    vectors = counts.groupBy("host", "token").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("class"),
        F.count("*").alias("support"),
        (F.max("n") == 1).alias("once"),
    )
    sizes = pages.groupBy("host").agg(F.count("*").alias("pages"))
    wide = vectors.join(broadcast_if_small(written(sizes, "sizes")), "host").where(
        (F.col("support") >= FEWEST_PAGES) & (F.col("support") >= SUPPORT * F.col("pages"))
    )
    grouped = wide.groupBy("host", "class", "support", "once")
    return grouped.agg(F.sort_array(F.collect_list("token")).alias("tokens"))


def _orders(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """For each page and class, the order of its tokens (as a hash; null if they do not repeat in
    one order) and, for the candidate root, its tokens in that order.
    """
    listed = classes.groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("class", "once", "tokens"))).alias("classes")
    )
    listed = broadcast_if_small(written(listed, "classes"))

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[], [], [], []]
        hosts, pages_, lists = (batch.column(i).to_pylist() for i in range(3))
        for host, tokens, known in zip(hosts, pages_, lists, strict=True):
            where = {t: i for i, c in enumerate(known) for t in c["tokens"]}
            seen: dict[int, list[int]] = {}
            for token in tokens:
                if token in where:
                    seen.setdefault(where[token], []).append(token)
            for i, sequence in seen.items():
                width = len(known[i]["tokens"])
                first = sequence[:width]
                whole = len(set(first)) == width and sequence == first * (len(sequence) // width)
                out[0].append(host)
                out[1].append(known[i]["class"])
                out[2].append(first if whole else None)
                out[3].append(whole)
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_()]
        columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["host", "class", "sequence", "whole"])

    rows = pages.select("host", "tokens").join(listed, "host").select("host", "tokens", "classes")
    return map_slices(rows, rule, "host long, class long, sequence array<long>, whole boolean")


def roots(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """``host``, ``root`` (its tokens in order) and ``nested`` (tokens of the other valid classes)."""
    ordered = _orders(pages, classes).groupBy("host", "class").agg(
        F.min("whole").alias("whole"),
        F.min("sequence").alias("sequence"),
        (F.min("sequence") == F.max("sequence")).alias("same"),
    )
    valid = classes.join(ordered.where("whole and same"), ["host", "class"])
    size = F.size("tokens")
    best = F.max_by("sequence", F.struct("support", size, "class"))
    root = valid.where(F.col("once") & (size >= FEWEST_TOKENS)).groupBy("host").agg(
        best.alias("root"), F.max(F.struct("support", size, "class"))["class"].alias("top")
    )
    others = valid.join(root.select("host", "top"), "host").where("class != top")
    nested = others.groupBy("host").agg(F.sort_array(F.flatten(F.collect_list("tokens"))).alias("inner"))
    return root.join(nested, "host", "left").select(
        "host", "root", F.coalesce("inner", F.array().cast("array<long>")).alias("inner")
    )


def gaps(tokens: list[int], root: list[int]) -> list[int] | None:
    """For each token the number of root tokens up to it; null unless the root is there in order."""
    found, at = [], 0
    wanted = set(root)
    for token in tokens:
        if token in wanted:
            if at == len(root) or token != root[at]:
                return None
            at += 1
        found.append(at)
    return found if at == len(root) else None


def _parts(gaps: list[int], flags: list[int], chars: list[int], links: list[int]) -> list[int]:
    """For each token its part of a slot: 4 * gap, + 2 inside the page's frame, + 1 on a loose page.

    The frame of a page are its articles, or else its main elements, if they hold unmarked text. A
    loose page has less than half of its unmarked and unlinked text there, or no frame.
    """
    text = [0 if flag & (TAG | CHROME) else n for flag, n in zip(flags, chars, strict=True)]
    seen = 0
    for flag, n in zip(flags, text, strict=True):
        seen |= flag if n else 0
    frame = IN_ARTICLE if seen & IN_ARTICLE else IN_MAIN if seen & IN_MAIN else 0
    inside = total = 0
    for flag, n, linked in zip(flags, text, links, strict=True):
        if n:
            total += n - linked
            inside += (n - linked) * bool(flag & frame)
    loose = not frame or inside < LEAST_FRAMED * total
    return [4 * gap + 2 * bool(flag & frame) + loose for gap, flag in zip(gaps, flags, strict=True)]


def slots(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """``host``, ``main``: which parts of the root's slots hold main text; ``constant``: template tokens.

    Sums over all pages of a host decide, those of loose pages apart. Parts inside the frame are main
    unless their text is mostly links, as that of teaser cards. On loose pages so are other parts whose
    text is neither marked as something else, nor mostly links, nor the template's own. Nested tokens
    must keep to one slot, or their class is no part of the template.
    """
    known = broadcast_if_small(templates)

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[] for _ in range(7)]
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for host, tokens, flags, chars, links, root, inner in zip(*columns, strict=True):
            places = gaps(tokens, root)
            if places is None:
                continue
            parts = _parts(places, flags, chars, links)
            own = {*root, *inner}
            sums: dict[int, list[int]] = {}
            spread: dict[int, tuple[int, int]] = {}
            for token, flag, n, linked, gap, part in zip(
                tokens, flags, chars, links, places, parts, strict=True
            ):
                if token in own:
                    low, high = spread.get(token, (gap, gap))
                    spread[token] = (min(low, gap), max(high, gap))
                # Within the frame, marked and own text goes block by block and says nothing of the rest.
                if flag & TAG or part % 4 >= 2 and (flag & CHROME or token in own):
                    continue
                cell = sums.setdefault(part, [0, 0, 0])
                cell[0] += n
                cell[1] += n * bool(flag & CHROME or token in own)
                cell[2] += linked
            for part, cell in sums.items():
                for column, value in zip(out, [host, part, *cell, None, None], strict=True):
                    column.append(value)
            for token, (low, high) in spread.items():
                for column, value in zip(out, [host, low, 0, 0, 0, token, high], strict=True):
                    column.append(value)
        names = ["host", "place", "chars", "marked", "linked", "token", "last_gap"]
        kinds = [pa.int64(), pa.int32()] + [pa.int64()] * 4 + [pa.int32()]
        arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    rows = pages.select("host", "tokens", "flags", "chars", "links").join(known, "host")
    schema = "host long, place int, chars long, marked long, linked long, token long, last_gap int"
    found = written(map_slices(rows, rule, schema), "slots")
    sums = found.where("token is null").groupBy("host", "place").agg(
        *[F.sum(c).alias(c) for c in ("chars", "marked", "linked")]
    )
    plain = (F.col("marked") <= MOST_MARKED * F.col("chars")) & (F.col("linked") <= MOST_LINKED * F.col("chars"))
    loose, inside = F.col("place") % 2 == 1, F.col("place") % 4 >= 2
    chosen = sums.groupBy("host").agg(
        F.collect_list(F.when(plain & (loose | inside), F.col("place"))).alias("main")
    )
    constant = found.where("token is not null").groupBy("host", "token").agg(
        (F.min("place") == F.max("last_gap")).alias("kept")
    )
    constant = constant.where("kept").groupBy("host").agg(F.collect_list("token").alias("constant"))
    return chosen.join(constant, "host", "left").select(
        "host", "main", F.coalesce("constant", F.array().cast("array<long>")).alias("constant")
    )


def main_text(page: str | None, root: list[int] | None, main: list[int] | None, constant: list[int] | None) -> str:
    """The main text of one page; without a template, by the marks of its elements alone."""
    return chosen_text(*_lists(markup.read(page)), root, main, constant)


def chosen_text(
    tokens: list[int],
    flags: list[int],
    chars: list[int],
    links: list[int],
    texts: list[str | None],
    root: list[int] | None,
    main: list[int] | None,
    constant: list[int] | None,
) -> str:
    """The main text of a page that has been read."""
    places = gaps(tokens, root) if root else None
    shown = [i for i, text in enumerate(texts) if text is not None]
    if places is not None:
        parts = _parts(places, flags, chars, links)
        open_parts, own = set(main or ()), set(constant or ())
        shown = [i for i in shown if parts[i] in open_parts and tokens[i] not in own]
    elif frame := next((f for f in (IN_ARTICLE, IN_MAIN) if any(flags[i] & f for i in shown)), 0):
        shown = [i for i in shown if flags[i] & frame]
    else:
        shown = [i for i in shown if links[i] <= MOST_LINKED * chars[i]]
    return "\n".join(texts[i] for i in shown)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` for every row of ``pages``.

    Null and empty pages, and pages without main text, have an empty text. Pages without a URL are
    taken as of one host. Pages of hosts with fewer than FEWEST_PAGES texts, or that lack their host's
    template, are read by the marks of their elements. Repeated rows stay repeated; pages of a host
    with the same text count as one when its template is deduced. Other columns are ignored; an empty
    table gives no rows. Every page is parsed once.
    """
    read = written(
        tokenised(pages).withColumn("page", F.monotonically_increasing_id()), "tokens"
    )
    evidence = read.drop("page_id", "url", "texts")
    once = written(distinct_bodies(evidence), "once")
    classes = written(equivalence_classes(once), "classes")
    templates = written(roots(once, classes), "roots")
    chosen = written(templates.join(slots(once, templates), "host").drop("inner"), "templates")

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(i).to_pylist() for i in range(2, batch.num_columns)]
        texts = [chosen_text(*row) for row in zip(*columns, strict=True)]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes]
        return pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    rows = read.join(broadcast_if_small(chosen), "host", "left")
    rows = rows.select("page_id", "url", *_LISTS, "root", "main", "constant")
    return map_slices(rows, rule, "page_id long, url string, text string, n_chars long")
