"""Media columns: interleaved sequences of text and media references, and a store of payloads by digest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text, html
from ._store import save

#: Samples in a line of the stored grey image; payloads are padded to a multiple of it.
WIDTH = 192
#: Cells of the feature's grid.
CELLS = 64
_BLOCKS = frozenset("address article aside blockquote body center dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
_HIDDEN = frozenset(("script", "style", "title", "noscript", "template", "iframe"))
_MEDIA = frozenset(("img", "audio", "video", "source", "embed"))

_ITEM_NAMES = ("position", "kind", "text", "digest", "caption")
ITEM = "struct<position:int,kind:string,text:string,digest:string,caption:string>"
_ITEM_TYPE = pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("digest", pa.string()), ("caption", pa.string())])


def parse(page: str) -> list[dict]:
    """A page's items in order: text blocks, and media with the digest of ``src`` and the caption.

    A caption is the text of the figcaption of the figure that holds the medium (before or after it), else the
    ``alt`` text, else null. Media in one figure share the caption. Figcaptions are no text items.
    """
    items: list[dict] = []
    words: list[str] = []
    caption: list[str] | None = None
    figure: list[dict] | None = None

    def flush() -> None:
        if words:
            text = html.clean("".join(words))
            words.clear()
            if text:
                items.append({"kind": "text", "text": text, "digest": None, "caption": None})

    for kind, name, value in html.events(page):
        if kind == "text":
            (words if caption is None else caption).append(value)
        elif kind == "raw":
            if name not in _HIDDEN:
                words.append(value)
        elif name in _MEDIA and kind == "open":
            found = html.attributes(value)
            if "src" in found:
                flush()
                item = {"kind": name, "text": None, "digest": found["src"].rpartition(":")[2], "caption": html.clean(found["alt"]) if "alt" in found else None}
                items.append(item)
                if figure is not None:
                    figure.append(item)
        elif name == "figcaption":
            flush()
            if kind == "open":
                caption = []
            elif caption is not None:
                if figure is not None:
                    figure.append({"caption_text": html.clean("".join(caption))})
                caption = None
        elif name == "figure":
            flush()
            if kind == "close" and figure is not None:
                said = next((x["caption_text"] for x in figure if "caption_text" in x), None)
                for x in figure:
                    if said and "kind" in x:
                        x["caption"] = said
            figure = [] if kind == "open" else None
        elif name in _BLOCKS or name == "br":
            (words if caption is None else caption).append(" ") if name == "br" else flush()
    flush()
    return [{"position": i, **x} for i, x in enumerate(items)]


def item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = batch.column("html").to_pylist()
        items = pa.array([parse(p or "") for p in pages], type=pa.list_(_ITEM_TYPE))
        keep = [i for i, name in enumerate(batch.schema.names) if name != "html"]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), items], [*(batch.schema.names[i] for i in keep), "items"])


def sequences(pages: DataFrame) -> DataFrame:
    """``html`` → ``items``, an ordered array of text and media structs; all other columns stay.

    Null and empty pages have no items. Positions count from 0 without gaps. A column named items is an error.
    """
    rest = [f for f in pages.schema.fields if f.name != "html"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), f"items array<{ITEM}>"])
    return pages.mapInArrow(item_rows, schema)


def payload(text: Column) -> Column:
    """UTF-8 bytes of a text (null: empty), filled with spaces to a positive multiple of ``WIDTH``."""
    text = F.coalesce(text, F.lit(""))
    n = F.octet_length(text)
    return F.concat(text, F.repeat(F.lit(" "), F.when(n == 0, WIDTH).otherwise((WIDTH - n % WIDTH) % WIDTH).cast("int"))).cast("binary")


def as_image(data: Column) -> Column:
    """Payload bytes as the 8-bit grey samples of a binary PGM image, ``WIDTH`` samples a line."""
    head = F.concat(F.lit(f"P5\n{WIDTH} "), (F.octet_length(data) / WIDTH).cast("long").cast("string"), F.lit("\n255\n"))
    return F.concat(head.cast("binary"), data)


def measure_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stored images → samples (read back and checked against the header) and their feature."""
    for batch in batches:
        for part in _text.slices(batch, "media"):
            data, offsets = _text.buffers(part.column("media"))
            raw = data.tobytes()
            starts = np.empty(part.num_rows, dtype=np.int64)
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                magic, size, depth = raw[a : a + 64].split(b"\n", 3)[:3]
                wide, high = map(int, size.split())
                starts[i] = a + len(magic) + len(size) + len(depth) + 3
                if magic != b"P5" or depth != b"255" or b - starts[i] != wide * high:
                    raise ValueError("a stored image does not hold the samples that its header names")
            yield pa.RecordBatch.from_arrays([part.column("digest"), part.column("media"), pa.array([raw[a:b] for a, b in zip(starts.tolist(), offsets[1:].tolist(), strict=True)], pa.binary()), pa.array(features(data, starts, offsets[1:]))], ["digest", "media", "samples", "feature"])


def features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
    """Mean and deviation of all samples, and which of 64 equal cells lie above the mean, as 16 hex digits."""
    n = end - start
    sums = np.concatenate([[0], np.cumsum(data, dtype=np.int64)])
    squares = np.concatenate([[0], np.cumsum(data.astype(np.int64) ** 2)])
    mean = (sums[end] - sums[start]) / n
    spread = np.sqrt(np.maximum((squares[end] - squares[start]) / n - mean**2, 0))
    edges = start[:, None] + n[:, None] * np.arange(CELLS + 1) // CELLS
    cells = np.diff(sums[edges], axis=1) / np.diff(edges, axis=1)
    bits = np.packbits(cells > mean[:, None], axis=1)
    return [f"{m:.4f};{s:.4f};{b.tobytes().hex()}" for m, s, b in zip(mean, spread, bits, strict=True)]


def store(media: DataFrame) -> DataFrame:
    """Write (digest, media) to the shared folder and return it as read back."""
    return save(media.select("digest", "media"), "media")


def measure(stored: DataFrame) -> DataFrame:
    """One row for each digest: sizes, checksums and feature of what the store holds."""
    rows = stored.mapInArrow(measure_rows, "digest string, media binary, samples binary, feature string").select(
        "digest",
        F.octet_length("samples").cast("long").alias("payload_bytes"),
        F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.substring("samples", -16, 16)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )
    return rows.dropDuplicates(["digest"])


def resolve(sequenced: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row for each item, with the columns that ``resolved`` has for its digest (null: text, or not stored).

    Items keep position and caption, so that a sort by position gives the document back. Pages without items give
    no row. ``resolved`` must hold a digest once. Columns of ``sequenced`` with the name of an item's field or of a column of
    ``resolved`` are dropped, as are columns of ``resolved`` with the name of an item's field. An empty table gives an empty result.
    """
    rest = [c for c in sequenced.columns if c not in ("items", *_ITEM_NAMES, *resolved.columns)]
    items = sequenced.select(*rest, F.inline("items"))
    more = [c for c in resolved.columns if c not in ("digest", *_ITEM_NAMES)]
    media = items.where("digest is not null").join(resolved.select("digest", *more), "digest", "left").select(*items.columns, *more)
    # text items have no digest: they stay out of the join, where all of them would meet in one partition
    return items.where("digest is null").select("*", *[F.lit(None).cast(resolved.schema[c].dataType).alias(c) for c in more]).unionByName(media)


def regroup(items: DataFrame, *key: str) -> DataFrame:
    """Resolved items → one row for each document, its items again in order of position."""
    rest = [c for c in items.columns if c not in (*key, "position")]
    return items.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("position", *rest))).alias("items"))


def op2_query(spark, sf_dir: str) -> DataFrame:
    """Each document as an interleaved page: a heading, its text as a captioned medium, a closing line; stored, parsed, joined by digest and read back.

    A row for each document: null and empty texts are a medium of one line of spaces, a null doc_id stays null, repeated rows
    give equal rows. An empty table gives an empty result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    image = as_image(payload(F.col("text")))
    kept = store(docs.select(F.sha2(image, 256).alias("digest"), image.alias("media")))
    page = F.concat(F.lit('<article><h1>Document</h1><figure><img src="sha256:'), F.sha2(image, 256), F.lit('" alt="text"><figcaption>'), F.octet_length("text").cast("string"), F.lit(" bytes</figcaption></figure><p>End</p></article>"))
    pages = docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), page.alias("html"))
    # written first: the join then shuffles a plain table and can split a very frequent digest over tasks
    return resolve(sequences(pages), save(measure(kept), "measured")).where("kind = 'img'").select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")
