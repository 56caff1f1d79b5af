r"""HTML extraction by nearest-URL page differencing.

A page is cut into blocks of visible text (lines). Pages are sorted by host and URL path.
Neighbouring copies, each of the one before it, are one run. A page is compared with the last page
before its run or the first one behind it, whichever path shares the longer beginning with its
own. The lines of the two are aligned by longest common subsequence; lines they share are template
and are deleted.

Two neighbours are copies if their lines outside aside parts are the same, or if nine tenths of the
lesser one's lines outside the host's template are on both. The host's template is the lines on
more than two thirds of its different pages, so that a long menu does not make copies of short
articles. Near copies that are more than two thirds of a host's different pages (or all of two)
cannot be told from a template.

Differencing alone cannot give the right text where a menu or an advert differs from page to page
(nothing is shared). So the page's own markup has a say, where there is any: lines in
navigation, headers, footers, sidebars, notices, adverts, forms and comment lists go whether shared
or not, as do those outside ``article`` and ``main``; lines inside them go where they are shared and
on three or more, and on more than two thirds, of the host's different pages.

Only line hashes are sorted and paired. Each range partition finds its runs; two pages of each tell
the driver what lies across its borders, so that results do not depend on the partitions.

Defined results: null or empty html gives the empty text; a null URL or one without a host is
paired with nothing; the first and the last run of a host have one neighbour, and a host of copies
none; repeated rows are pages of their own; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import pickle
import re
import zlib
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitroll.llm.common import cut

COPY_SHARE = 0.9
MAX_TABLE = 1 << 28       # bits of one alignment table; longer pages are halved first

TOKEN = re.compile(
    r"<!--.*?(?:-->|(?P<unended>\Z))"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|title|object)\b[^>]*>"
    r".*?(?:</(?P=raw)\s*>|(?P<unclosed>\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>"
    r"|<(?P<end_2>/?)(?P<tag_2>[a-zA-Z][^\s/>]*)(?P<rest_2>[^>]*)>", re.S | re.I)
NAMED = re.compile(r"(?:^|\s)(class|id|role|aria-label|hidden|aria-hidden|style)"
                   r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no main text.
ASIDE_TAGS = frozenset("nav header footer aside form menu dialog head button select".split())
#: Words in class, id, role or label that mark such parts.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments complementary consent contentinfo cookie cookies disqus footer gdpr header login "
    "masthead menu modal nav navbar navigation newsletter notice notices notification pager "
    "pagination popup promo promoted promotion recommended related replies reply respond search "
    "share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar "
    "widget widgets".split())
#: Words beside which those name a layout, not a part ("with-sidebar").
LAYOUT_WORDS = frozenset("with has no without layout".split())
CONTENT_TAGS = frozenset(["article", "main"])
#: Open elements that an opening tag ends without a closing tag.
ENDED_BY = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
            "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
            "option": {"option"}}


def _aside(tag: str, attributes: str, in_content: bool) -> bool:
    if tag in ASIDE_TAGS and not (tag == "header" and in_content):
        return True
    if not attributes or tag in ("body", "html"):
        return False
    for m in NAMED.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif name != "aria-hidden":
            words = {w.lower() for w in WORD.findall(value)}
            if in_content:
                words.discard("header")
            if words & ASIDE_WORDS and not words & LAYOUT_WORDS:
                return True
    return False


def page_lines(page: str) -> list[tuple[str, bool, bool]]:
    """``(text, in an aside part, in article or main)`` per block of visible text, in order."""
    lines: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    stack: list[list] = []       # open elements: tag, aside below it, content below it
    aside = content = False

    def close_block():
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                lines.append((text, aside, content))
            parts.clear()

    # No tag ends behind the last ">": the scan stops there, and only a comment may begin later.
    scanned, at = page.rfind(">") + 1, 0
    open_tags: Counter = Counter()
    for m in TOKEN.finditer(page, 0, scanned):
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        if m["unended"] is not None or m["unclosed"] is not None:
            at = scanned = len(page)
        tag = m["tag"] or m["tag_2"]
        if not tag:
            continue
        tag, attributes = tag.lower(), m["rest"] or m["rest_2"] or ""
        closing = bool(m["end"] or m["end_2"])
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            # Inline elements matter only where one is marked as an aside part.
            if tag in VOID or not (open_tags[tag] or not closing
                                   and _aside(tag, attributes, content)):
                continue
        close_block()
        if tag in VOID or attributes.endswith("/"):
            continue
        if closing:
            last = None
            while open_tags[tag] and last != tag:
                last, aside, content = stack.pop()
                open_tags[last] -= 1
            continue
        ended = ENDED_BY.get(tag, {"p"})
        while stack and tag not in INLINE and stack[-1][0] in ended:
            last, aside, content = stack.pop()
            open_tags[last] -= 1
        stack.append([tag, aside, content])
        open_tags[tag] += 1
        if _aside(tag, attributes, content):
            aside = True
        elif tag == "main":
            aside, content = False, True          # an unclosed part before it ends here
        elif tag == "article" and not aside:
            content = True
    if at < len(page):
        note = page.find("<!--", scanned)
        parts.append(page[at:note] if note >= 0 else page[at:])
    close_block()
    return lines


# --------------------------------------------------------------------------------- alignment

def _rows(a: list, b: list) -> list[int]:
    """Per row of ``a``, a bit per row of ``b``: 0 where the common subsequence of the
    beginnings grows by one."""
    full = (1 << len(b)) - 1
    masks: dict = {}
    for k, x in enumerate(b):
        masks[x] = masks.get(x, 0) | (1 << k)
    v, rows = full, []
    for x in a:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    return rows


def shared_lines(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    out = list(range(head))
    ma, mb = a[head:len(a) - tail], b[head:len(b) - tail]
    if ma and mb:
        if len(ma) * len(mb) <= MAX_TABLE or len(ma) == 1:
            out += [head + k for k in _trace(ma, mb)]
        else:
            half = len(ma) // 2
            cut = _best_cut(_rows(ma[:half], mb)[-1],
                            _rows(ma[half:][::-1], mb[::-1])[-1], len(mb))
            out += [head + k for k in shared_lines(ma[:half], mb[:cut])]
            out += [head + half + k for k in shared_lines(ma[half:], mb[cut:])]
    return out + list(range(len(a) - tail, len(a)))


def _best_cut(front: int, back: int, width: int) -> int:
    """Where to cut ``b`` so that the two halves align best."""
    ahead = [0]
    for k in range(width):
        ahead.append(ahead[-1] + (not back >> k & 1))
    best, at, length = -1, 0, 0
    for k in range(width + 1):
        if length + ahead[width - k] > best:
            best, at = length + ahead[width - k], k
        if k < width:
            length += not front >> k & 1
    return at


def _trace(a: list, b: list) -> list[int]:
    rows, out = _rows(a, b), []
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        elif i > 1 and not rows[i - 2] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append(i)
    return out[::-1]


def line_hashes(lines: list[tuple[str, bool, bool]]) -> list[int]:
    """A hash of 63 bits per line, and whether it lies in an aside part as the lowest bit."""
    return [int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"),
                                           digest_size=8).digest(), "little", signed=True) & ~1
            | aside for text, aside, _ in lines]


def marked(lines: list[tuple[str, bool, bool]]) -> bool:
    """Whether the page's own markup tells its main text."""
    return any(content and not aside for _, aside, content in lines)


def main_text(lines: list[tuple[str, bool, bool]], other: list[int], template: list[int] = ()) -> str:
    """Text of a page from its lines, the line hashes of its neighbour and the host's template. A
    shared line inside ``article`` or ``main`` goes only if it is also template."""
    own, hashes, firm = marked(lines), [h & ~1 for h in line_hashes(lines)], set(template)
    shared = set(shared_lines(hashes, [h & ~1 for h in other]))
    return "\n\n".join(text for k, (text, aside, content) in enumerate(lines) if not aside and (
        content and not (k in shared and hashes[k] in firm) if own else k not in shared))


# ---------------------------------------------------------------------------------- neighbours

def _near(path: str, other: str) -> int:
    n = 0
    for a, b in zip(path, other):
        if a != b:
            break
        n += 1
    return n


def copies(a: tuple, b: tuple) -> bool:
    """Whether two pages ``(host, key, path, seen, own)`` of a host, with all their lines outside
    aside parts and with those outside the host's template, are copies."""
    if a[3] == b[3]:
        return True
    least = min(len(a[4]), len(b[4]))
    return least > 0 and len(a[4] & b[4]) >= COPY_SHARE * least


def runs(pages: list[tuple]) -> list[tuple[int, int]]:
    """``(from, to)`` of the runs of copies among sorted pages: a page that is a copy of the one
    before it, on the same host, is in its run."""
    starts = [k for k, p in enumerate(pages)
              if not k or p[0] != pages[k - 1][0] or not copies(pages[k - 1], p)]
    return list(zip(starts, starts[1:] + [len(pages)]))


def _place(pages: list[tuple], host: str, k: int):
    return pages[k][1:3] if 0 <= k < len(pages) and pages[k][0] == host else (None, None)


def across(edges: list[tuple]) -> list[tuple]:
    """``(part, before, after)`` per part: the page before its first run and the one behind its
    last, both ``(key, path)``. ``edges``: ``(part, first page, last page, page behind the first
    run, page before the last run, whether all is one run)``, sorted."""
    nothing = (None, None)
    before, after = {}, {}
    for p, q in zip(edges, edges[1:]):
        if p[2][0] != q[1][0]:
            before[q[0]] = nothing
        elif not copies(p[2], q[1]):
            before[q[0]] = p[2][1:3]
        else:
            before[q[0]] = before.get(p[0], nothing) if p[5] else p[4]
    for p, q in list(zip(edges, edges[1:]))[::-1]:
        if p[2][0] != q[1][0]:
            after[p[0]] = nothing
        elif not copies(p[2], q[1]):
            after[p[0]] = q[1][1:3]
        else:
            after[p[0]] = after.get(q[0], nothing) if q[5] else q[3]
    return [(e[0], *before.get(e[0], nothing), *after.get(e[0], nothing)) for e in edges]


# ------------------------------------------------------------------------------------- Spark

def _rows_of(batches):
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in b.slice(lo, 256).columns))


def _batches(rows, schema: pa.Schema, weight):
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += weight(row)
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)],
                                             schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)],
                                         schema=schema)


def _key(page_id, url, hashes: list[int]) -> bytes:
    """Rows with the same key have the same text."""
    return hashlib.blake2b(repr((page_id, url, hashes)).encode("utf-8", "surrogatepass"),
                           digest_size=16).digest()


def _signatures(keyed: DataFrame) -> DataFrame:
    """``host, path, page_id, key, seen, lines``: line hashes of every different page with a host,
    ``seen`` a hash of those outside aside parts."""
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64()),
                        ("key", pa.binary()), ("seen", pa.binary()),
                        ("lines", pa.list_(pa.int64()))])

    def run(batches):
        def rows():
            for page_id, url, host, path, page in _rows_of(batches):
                h = line_hashes(page_lines(page))
                seen = hashlib.blake2b(repr([x for x in h if not x & 1]).encode(), digest_size=16)
                yield host, path, page_id, _key(page_id, url, h), seen.digest(), h
        return _batches(rows(), schema, lambda r: 8 * len(r[5]) + 200)

    return (keyed.where("host <> ''").mapInArrow(
        run, "host string, path string, page_id long, key binary, seen binary, lines array<long>"))


def _templates(signed: DataFrame) -> DataFrame:
    """``part, host, template, firm`` for every part that holds pages of a host: the lines on more than
    two thirds of the host's different pages, ``firm`` those of them on three or more."""
    different = cut(signed.groupBy("host", "seen").agg(F.first("lines").alias("lines")), "different")
    pages = different.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    line = F.explode(F.array_distinct(F.filter("lines", lambda h: h.bitwiseAND(F.lit(1)) == 0)))
    held = (different.select("host", line.alias("line")).groupBy("host", "line")
            .agg(F.count(F.lit(1)).alias("held")).where("held > 1"))
    template = (held.join(pages, "host").where("3 * held > 2 * pages")
                .groupBy("host").agg(F.collect_list("line").alias("template"),
                                     F.collect_list(F.when(F.col("held") > 2, F.col("line"))).alias("firm")))
    return cut(signed.select("part", "host").distinct().join(template, "host"), "templates")


def _partners(signed: DataFrame, templates: DataFrame) -> DataFrame:
    """``key, partner``: the page each page is compared with. Runs are found part by part; what
    lies across the borders of a part is settled from two pages of each part on the driver."""

    def scan(rows: pd.DataFrame, templates: pd.DataFrame) -> pd.DataFrame:
        template = {h: set(t) for h, t in zip(templates["host"], templates["template"])}
        rows = rows.sort_values(["host", "path", "page_id", "key"])
        pages = [(h, k, p, s, {x for x in lines if not x & 1} - template.get(h, set()))
                 for h, k, p, s, lines in zip(rows["host"], rows["key"], rows["path"],
                                              rows["seen"], rows["lines"])]
        if not pages:
            return pd.DataFrame(columns=names)
        part, out, found = int(rows["part"].iloc[0]), [], runs(pages)
        for lo, hi in found:
            host = pages[lo][0]
            around = (*_place(pages, host, lo - 1), *_place(pages, host, hi))
            out += [(part, p[1], p[2], *around, lo == 0, hi == len(pages), None)
                    for p in pages[lo:hi]]
        first, last = found[0], found[-1]
        edge = (part, pages[0], pages[-1], _place(pages, pages[0][0], first[1]),
                _place(pages, pages[-1][0], last[0] - 1), len(found) == 1)
        out.append((part, *[None] * 6, False, False, pickle.dumps(edge)))
        return pd.DataFrame(out, columns=names)

    names = ["part", "key", "path", "before", "before_path", "after", "after_path", "opens",
             "closes", "edge"]
    scanned = (signed.groupBy("part").cogroup(templates.drop("firm").groupBy("part")).applyInPandas(
        scan, "part int, key binary, path string, before binary, before_path string, after binary,"
              " after_path string, opens boolean, closes boolean, edge binary"))
    scanned = cut(scanned, "runs")
    edges = sorted((pickle.loads(r["edge"]) for r in
                    scanned.where("edge IS NOT NULL").select("edge").collect()),
                   key=lambda e: e[0])
    beyond = signed.sparkSession.createDataFrame(
        across(edges), "part int, b binary, b_path string, a binary, a_path string")
    one = lambda open_, far, near: F.when(open_, F.col(far)).otherwise(F.col(near))
    both = scanned.where("edge IS NULL").join(F.broadcast(beyond), "part").select(
        "key", "path", one(F.col("opens"), "b", "before").alias("before"),
        one(F.col("opens"), "b_path", "before_path").alias("before_path"),
        one(F.col("closes"), "a", "after").alias("after"),
        one(F.col("closes"), "a_path", "after_path").alias("after_path"))

    def choose(batches):
        for b in batches:
            keys, partners = [], []
            for key, path, before, before_path, after, after_path in _rows_of([b]):
                if before is not None and after is not None:
                    nearer = _near(path, before_path) >= _near(path, after_path)
                    partner = before if nearer else after
                else:
                    partner = after if before is None else before
                if partner is not None:
                    keys.append(key)
                    partners.append(partner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(partners, pa.binary())],
                names=["key", "partner"])

    return both.mapInArrow(choose, "key binary, partner binary")


def packed(lines: list[tuple[str, bool, bool]]) -> bytes:
    """The lines of a page as they go through a shuffle, at about two fifths of their length."""
    return zlib.compress("\n".join(f"{aside + 2 * content}{text}" for text, aside, content in lines)
                         .encode("utf-8"), 1)


def unpacked(data: bytes) -> list[tuple[str, bool, bool]]:
    text = zlib.decompress(data).decode("utf-8")
    return [(x[1:], x[0] in "13", x[0] in "23") for x in text.split("\n")] if text else []


def _texts(keyed: DataFrame) -> DataFrame:
    """Every page with its key and packed lines."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("key", pa.binary()),
                        ("lines", pa.binary())])

    def run(batches):
        def rows():
            for page_id, url, _, _, page in _rows_of(batches):
                lines = page_lines(page)
                yield page_id, url, _key(page_id, url, line_hashes(lines)), packed(lines)
        return _batches(rows(), schema, lambda r: len(r[3]) + 200)

    return keyed.mapInArrow(run, "page_id long, url string, key binary, lines binary")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages`` (page_id, url, html)."""
    url = F.coalesce("url", F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"),
        F.coalesce("html", F.lit("")).alias("html"))
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed = cut(_signatures(keyed).repartitionByRange(n, "host", "path", "page_id", "key")
                 .withColumn("part", F.spark_partition_id()), "signatures")
    signed = signed.dropDuplicates(["part", "key"])          # equal rows lie in one part
    templates = _templates(signed)
    others = (_partners(signed, templates).join(
        signed.select(F.col("key").alias("partner"), F.col("lines").alias("other"), "part", "host"), "partner")
        .join(templates.select("part", "host", "firm"), ["part", "host"], "left"))

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches):
        def rows():
            for page_id, url, lines, other, firm in _rows_of(batches):
                yield page_id, url, main_text(unpacked(lines), other or [], firm or [])
        return _batches(rows(), schema, lambda r: len(r[2]) + 200)

    return (_texts(keyed).join(others.select("key", "other", "firm"), "key", "left")
            .select("page_id", "url", "lines", "other", "firm")
            .mapInArrow(run, "page_id long, url string, text string")
            .withColumn("n_chars", F.char_length("text").cast("long")))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
