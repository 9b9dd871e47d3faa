"""Formats that are read file by file: a registry of page readers, by reader name or by suffix.

A reader has ``pages(content, path) -> [(native text, metadata, image or None)]``. Word documents and images
have one here; PDF, .msg, .doc and .xls need libraries that are absent, so a caller plugs theirs in under
"pdf", ".msg" and so on. What can't be read is told with its error, and doesn't stop the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.providers import PageReader
from quire.sources.images import ImageReader
from quire.sources.office import DocxReader
from quire.sources.routing import suffix

ATTEMPTS = 3
READ = "source_path string, page_number int, native_text string, metadata map<string,string>, image binary, error string"


def default_readers() -> dict[str, PageReader]:
    return {"docx": DocxReader(), "image": ImageReader()}


def read_pages(files: DataFrame, readers: dict[str, PageReader] | None = None, attempts: int = ATTEMPTS) -> DataFrame:
    """READ rows of files (source_path, content, reader) that a registered reader takes, a row a page; a file
    that fails gives one row with its error and no page number. Broken connections are tried again."""
    known = default_readers() | (readers or {})

    def one(path, content, name, end):
        reader = known.get(end) or known[name]
        for attempt in range(attempts):
            try:
                return [(path, i + 1, text, list(told.items()), image, None) for i, (text, told, image) in enumerate(reader.pages(bytes(content), path))]
            except (ConnectionError, TimeoutError) as e:
                error = e
            except Exception as e:  # noqa: BLE001  what went wrong is the row's content
                error = e
                break
        return [(path, None, None, None, None, f"{type(error).__name__}: {error}".splitlines()[0])]

    def run(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.string()]
        names = [f.split(" ")[0] for f in READ.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):  # a file at a time: its pages may be large
                rows = one(*(c[i].as_py() for c in batch.columns))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 6, kinds)], names)

    end = suffix(F.col("source_path"))
    taken = files.where(F.col("reader").isin(*known) | end.isin(*known))
    return taken.select("source_path", "content", "reader", end.alias("suffix")).mapInArrow(run, READ)
