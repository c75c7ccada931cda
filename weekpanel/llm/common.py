"""What the operators of this folder share: text columns computed in Arrow batches, label folds, bounded training samples."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

FOLDS = 5
#: Results that are collected to be broadcast stay below this many bytes; operators have another way beyond it.
BROADCAST_BYTES = 32 << 20
CHUNK_CHARS = 1_000_000

_ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where an installed public tokenizer file is; every operator takes another path too."""
    import public_tokenizers

    return public_tokenizers.path(name)


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8, unchanged; none for null."""
    return text.encode().split() if text else []


def lower_ascii(text: str) -> bytes:
    return text.encode().translate(_ASCII_LOWER)


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo the number of folds; fold 0 is held out. A null id has no fold: it is null."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % FOLDS


def is_held_out(doc_id: str) -> Column:
    """True for fold 0; a null id is not held out."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def py_fold(doc_id: object) -> int:
    return zlib.crc32(str(doc_id).encode()) % FOLDS


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the table has such a column."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def rows_where(df: DataFrame, columns: list[str], compute: Callable[[DataFrame], DataFrame], condition: str) -> DataFrame:
    """The rows of ``df``, as they are, for which ``condition`` holds on what ``compute`` adds to the named columns.

    Columns of ``df`` whose names ``compute`` uses keep their values.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    marked = compute(df.select(whole, *[F.col(f"`{c}`") for c in columns]))
    return marked.where(condition).select("_row.*")


def text_columns(
    df: DataFrame, fields: str, setup: Callable[[], object], work: Callable, text: str = "text", many: bool = False
) -> DataFrame:
    """Add the columns ``fields`` (DDL), which ``work(state, text)`` returns as one tuple for each text (None stays None).

    With ``many``, ``work`` takes a list of texts, of about ``CHUNK_CHARS`` characters, and returns a list of tuples.
    Only the text goes to Python, in Arrow batches; every other column stays where it is. ``setup`` runs once a task.
    New columns replace columns of the same names.
    """
    schema = StructType.fromDDL(fields)
    arrow = to_arrow_type(schema)

    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        state = setup()
        for batch in batches:
            # Results leave chunk by chunk, so that a worker holds those of few texts at a time.
            for some in chunks(batch):
                rows = work(state, some) if many else [work(state, t) for t in some]
                columns = zip(*rows, strict=True)
                yield pa.StructArray.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], fields=list(arrow)
                )

    udf = F.arrow_udf(compute, schema)
    packed = unused(df, "_packed")
    out = df.withColumn(packed, udf(F.col(f"`{text}`").cast("string")))
    return out.withColumns({f: F.col(f"{packed}.{f}") for f in schema.names}).drop(packed)


def chunks(batch: pa.Array) -> Iterator[list[str | None]]:
    some, size = [], 0
    for t in batch:
        some.append(t.as_py())
        size += len(some[-1] or "")
        if size >= CHUNK_CHARS:
            yield some
            some, size = [], 0
    if some:
        yield some


def by_hash(ids: DataFrame, key: str, share: Column, seed: int) -> DataFrame:
    """Rows whose hashed key falls below ``share`` (0 to 1): the same rows however the table is split or ordered."""
    spread = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    return ids.where(spread < share)



def split_special(contents: list[str]) -> re.Pattern | None:
    """A pattern that keeps special tokens apart from ordinary text: leftmost, longest first; None if there are none."""
    ordered = sorted(contents, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if ordered else None


class Assigned:
    """Tells whether all characters of a text are assigned ones. Libraries of other Unicode versions class the rest anew."""

    def __init__(self):
        self.known: set[str] = set()

    def all_of(self, text: str) -> bool:
        if text.isascii():
            return True
        if new := set(text) - self.known:
            if any(unicodedata.category(c) == "Cn" for c in new):
                return False
            self.known |= new
        return True
