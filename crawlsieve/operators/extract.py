"""Main-text extraction (P6 default profile, P7 strict profile).

A partition-parallel ``mapInArrow`` job: each Python worker streams Arrow
batches of (id, html) through a small block extractor built on the
standard library's ``html.parser``; only the id and the extracted text
come back.  Rules are ours (the third-party extractor the reference
calls is not available):

* drop ``script style noscript template nav header footer aside form``
  subtrees (plus ``table`` without ``include_tables``, plus containers
  whose id/class has the token ``comment``/``comments`` without
  ``include_comments``);
* if the page has ``article`` elements, keep only their content, else
  ``main`` elements, else the whole page;
* block tags end a line; whitespace runs collapse to one space per line;
  empty lines are dropped; lines are joined with ``\\n``;
* ``dedup_blocks`` removes a line identical to an earlier one;
* no text -> NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsieve.operators.batching import unused
from crawlsieve.session import written

# Fixed values of the extraction rules.
DROP_TAGS = ("script", "style", "noscript", "template", "nav", "header", "footer", "aside", "form")
BLOCK_TAGS = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "br", "div", "ul", "ol",
              "blockquote", "pre", "td", "th", "tr", "table", "section", "article", "main",
              "title", "body", "html", "head", "hr", "dd", "dt", "dl", "figcaption")
VOID_TAGS = ("br", "hr", "img", "meta", "link", "input", "wbr", "source", "area", "base", "col",
             "embed", "param", "track")
COMMENT_TOKENS = ("comment", "comments")


def extract_main_text(html: str | None, include_tables: bool = True, include_comments: bool = True,
                      dedup_blocks: bool = False) -> str | None:
    """Per-document helper used inside the Arrow batch loop."""
    if not html:
        return None
    from html.parser import HTMLParser

    drop = set(DROP_TAGS)
    if not include_tables:
        drop.add("table")
    blocks = set(BLOCK_TAGS)
    voids = set(VOID_TAGS)

    class _P(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.drop_stack: list[str] = []
            self.scope = {"article": [], "main": [], "all": []}
            self.depth = {"article": 0, "main": 0}

        def _emit(self, s):
            for k in ("article", "main"):
                if self.depth[k] > 0:
                    self.scope[k].append(s)
            self.scope["all"].append(s)

        def handle_starttag(self, tag, attrs):
            if self.drop_stack:
                if tag == self.drop_stack[0] and tag not in voids:
                    self.drop_stack.append(tag)
                return
            dropped = tag in drop
            if not dropped and not include_comments:
                toks = " ".join(v or "" for k, v in attrs if k in ("id", "class")).lower().split()
                dropped = any(t in COMMENT_TOKENS for t in toks)
            if dropped and tag not in voids:
                self.drop_stack.append(tag)
                return
            if tag in blocks:
                self._emit("\n")
            if tag in self.depth:
                self.depth[tag] += 1
                self.scope[tag].append("\n")

        def handle_startendtag(self, tag, attrs):
            if not self.drop_stack and tag in blocks:
                self._emit("\n")

        def handle_endtag(self, tag):
            if self.drop_stack:
                if tag == self.drop_stack[0]:
                    self.drop_stack.pop()
                return
            if tag in self.depth and self.depth[tag] > 0:
                self.depth[tag] -= 1
                self.scope[tag].append("\n")
            if tag in blocks:
                self._emit("\n")

        def handle_data(self, data):
            if not self.drop_stack:
                self._emit(data)

    p = _P()
    try:
        p.feed(html)
        p.close()
    except Exception:  # malformed markup: keep what was parsed
        pass
    if p.scope["article"]:
        parts = p.scope["article"]
    elif p.scope["main"]:
        parts = p.scope["main"]
    else:
        parts = p.scope["all"]
    lines = []
    seen = set()
    for line in "".join(parts).split("\n"):
        line = " ".join(line.split())
        if not line:
            continue
        if dedup_blocks:
            if line in seen:
                continue
            seen.add(line)
        lines.append(line)
    return "\n".join(lines) if lines else None


def main_text(df: DataFrame, id_cols=("page_id",), html: str = "html", out: str = "text",
              include_tables: bool = True, include_comments: bool = True,
              dedup_blocks: bool = False) -> DataFrame:
    """Return ``id_cols + [out]``: the main text of every row's HTML.

    Only the id columns and the HTML are shipped to Python; join the text
    back or carry more ids if more columns are needed downstream.
    """
    ids = list(id_cols)
    src = df.select(*ids, html)
    schema = T.StructType([src.schema[c] for c in ids] + [T.StructField(out, T.StringType())])

    def run(batches):
        import pyarrow as pa
        for b in batches:
            htmls = b.column(html).to_pylist()
            texts = [extract_main_text(h, include_tables, include_comments, dedup_blocks) for h in htmls]
            cols = [b.column(c) for c in ids] + [pa.array(texts, type=pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[*ids, out])

    return src.mapInArrow(run, schema)


def main_text_strict(df: DataFrame, **kw) -> DataFrame:
    """Tables and comment containers dropped, repeated blocks removed."""
    kw.setdefault("include_tables", False)
    kw.setdefault("include_comments", False)
    kw.setdefault("dedup_blocks", True)
    return main_text(df, **kw)


# Fixed values of the duplicate rule: blocks of so many characters count, and
# those on more pages than this are dropped.
LEAST_BLOCK_CHARS = 100
MOST_PAGES = 2


def drop_repeated_blocks(texts: DataFrame, text: str = "text", least_chars: int = LEAST_BLOCK_CHARS,
                         most_pages: int = MOST_PAGES) -> DataFrame:
    """Blocks (lines of the text) repeated across pages are dropped from all of them.

    A block counts once a page.  Hashes of blocks are counted with a map-side partial
    step; the frequent ones leave by an anti join, and the rest is put together again in
    order.  Short blocks are never dropped; a text without any block left is NULL.
    """
    row, at, block, h = (unused(n, texts.columns) for n in ("_row", "_at", "_block", "_hash"))
    rows = written(texts.withColumn(row, F.monotonically_increasing_id()), "texts")
    blocks = (rows.where(F.col(text).isNotNull()).select(row, F.posexplode(F.split(text, "\n")).alias(at, block))
              .withColumn(h, F.when(F.length(block) >= least_chars, F.sha2(block, 256))))
    frequent = (blocks.where(F.col(h).isNotNull()).select(row, h).distinct().groupBy(h).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > most_pages).select(h))
    kept = (blocks.join(frequent, h, "left_anti").groupBy(row)
            .agg(F.sort_array(F.collect_list(F.struct(at, block))).alias("_b"))           # the blocks of one page
            .select(F.col(row).alias("_r"), F.array_join(F.transform("_b", lambda b: b[block]), "\n").alias("_kept")))
    return (rows.join(kept, F.col(row) == F.col("_r"), "left")
            .select(*[F.col("_kept").alias(c) if c == text else F.col(c) for c in texts.columns]))


def main_text_unique(df: DataFrame, **kw) -> DataFrame:
    """P7 over a corpus: strict main text without the blocks that pages share."""
    out = kw.get("out", "text")
    return drop_repeated_blocks(main_text_strict(df, **kw), text=out)
