"""Regions on pages: virtual layout of text, reading order by recursive XY cuts, crops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.arrays import let, run_starts, scan
from quire.functions.text import non_empty
from quire.schema import BBOX

# Geometry of a rendered text page, in pixels at 300 dots per inch.
PAGE_WIDTH, PAGE_HEIGHT = 2480.0, 3508.0
MARGIN, LINE_HEIGHT, WRAP_CHARS = 120, 36, 100
A4_HEIGHT, A4_DPI = 3508, 300
MIN_DPI = 150
SCANNED_CHARS = 50
GAP = 20.0
CROP_PAD = 8
MAX_SKEW = 5.0

# Region type by detector class; all other classes are text.
DETECTOR_CLASSES = {3: "table", 4: "figure", 5: "caption", 6: "caption", 7: "header", 8: "footer", 10: "formula"}
TABLE_LINES = 3


def bbox(x0, y0, x1, y1, width=None, height=None) -> Column:
    width, height = (F.lit(d) if v is None else v for v, d in ((width, PAGE_WIDTH), (height, PAGE_HEIGHT)))
    names = ("x0", "y0", "x1", "y1", "page_width", "page_height")
    return F.struct(*[c.cast("double").alias(n) for c, n in zip((x0, y0, x1, y1, width, height), names)]).cast(BBOX)


def box_measures(box: Column) -> dict[str, Column]:
    width, height = box["x1"] - box["x0"], box["y1"] - box["y0"]
    return {"width": width, "height": height, "area": width * height, "cx": (box["x0"] + box["x1"]) / 2, "cy": (box["y0"] + box["y1"]) / 2}


def region_type(class_id: Column) -> Column:
    pairs = [F.lit(x) for item in DETECTOR_CLASSES.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), class_id.cast("int")), F.lit("text"))


def is_scanned(native_text: Column) -> Column:
    from quire.functions.text import strip

    return F.coalesce(F.length(strip(native_text)), F.lit(0)) < SCANNED_CHARS


def estimated_dpi(height: Column) -> Column:
    return height * A4_DPI / A4_HEIGHT


def upscale_factor(height: Column) -> Column:
    """2 for images under the least resolution, else 1."""
    return F.when(estimated_dpi(height) < MIN_DPI, 2).otherwise(1)


def skew_angle(lines: DataFrame, key: str = "page_id", angle: str = "angle") -> DataFrame:
    """(key, rotation): minus the median of the line angles under five degrees; pages without one: 0."""
    near = F.when(F.abs(angle) < MAX_SKEW, F.col(angle))
    return lines.groupBy(key).agg(F.coalesce(-F.median(near), F.lit(0.0)).alias("rotation"))


def full_page_regions(pages: DataFrame) -> DataFrame:
    """The detector's stand-in without weights: the page as one text region, confidence 1."""
    return pages.select("document_id", "page_number", F.lit(0).alias("region_index"), F.lit("text").alias("region_type"), bbox(F.lit(0), F.lit(0), F.lit(PAGE_WIDTH), F.lit(PAGE_HEIGHT)).alias("bbox"), F.col("native_text").alias("text"), F.lit(1.0).alias("detector_confidence"))


# Least confidence of a detection, and the overlap from which a weaker one goes.
MIN_CONFIDENCE, MAX_OVERLAP = 0.25, 0.45


def overlap(a: tuple, b: tuple) -> float:
    """Intersection over union of two boxes (x0, y0, x1, y1)."""
    width, height = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(0.0, width) * max(0.0, height)
    either = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return both / either if either > 0 else 0.0


def suppressed(found: list[tuple], least: float = MIN_CONFIDENCE, most: float = MAX_OVERLAP) -> list[tuple]:
    """Detections (class, x0, y0, x1, y1, confidence) of ``least`` confidence, surest first, without those that
    overlap a surer one of their class."""
    kept: list[tuple] = []
    for d in sorted((d for d in found if d[5] >= least), key=lambda d: -d[5]):
        if all(d[0] != k[0] or overlap(d[1:5], k[1:5]) <= most for k in kept):
            kept.append(d)
    return kept


def preprocess(pages: DataFrame, steps) -> DataFrame:
    """Pages with their image column cleaned up: deskewed, denoised, contrast evened, and doubled in size if
    under the least resolution; ``steps`` has these four as methods. Pages without image stay as they are."""
    at, height = pages.columns.index("image"), pages.withColumn("__h", F.col("metadata")["height"].cast("double"))
    rows = height.select(*pages.columns, F.coalesce(upscale_factor(F.col("__h")), F.lit(1)).alias("__factor"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for image, factor in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                if image is not None:
                    image = steps.contrast(steps.denoise(steps.deskew(image)))
                    image = steps.enlarge(image, factor) if factor > 1 else image
                out.append(image)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()) if i == at else c for i, c in enumerate(batch.columns[:-1])], batch.schema.names[:-1])

    return rows.mapInArrow(run, pages.schema)


def crop_regions(regions: DataFrame, pages: DataFrame, cropper, pad: float = CROP_PAD) -> DataFrame:
    """``regions`` with crop (the region's image) and content_hash of it; null where the page has no image or the
    cropper fails on it."""
    box = crop_box(F.col("bbox"), pad)
    key = ["document_id", "page_number", "region_index"]
    images = pages.where("image is not null").select("document_id", "page_number", "image")
    asked = regions.join(images, ["document_id", "page_number"]).select(*key, "image", *[box[c].alias(c) for c in ("x0", "y0", "x1", "y1")])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for image, *corners in zip(*(c.to_pylist() for c in batch.columns[3:])):
                try:
                    out.append(cropper.crop(image, *corners))
                except Exception:  # noqa: BLE001  a region that can't be cropped stays a region
                    out.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], [*key, "crop"])

    kinds = {c: asked.schema[c].dataType.simpleString() for c in key}
    crops = asked.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in key) + ", crop binary")
    return regions.join(crops.withColumn("content_hash", F.sha2("crop", 256)), key, "left")


def detect_regions(pages: DataFrame, detector, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Regions that a detector finds on pages with an image column, surest first.

    The detector is any object with ``detect(image) -> [(class, x0, y0, x1, y1, confidence)]`` and
    ``size(image) -> (width, height)``; it is sent to the executors once a task.
    """
    schema = "document_id string, page_number int, region_index int, class_id int, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double, detector_confidence double"

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for document, page, image in zip(*(c.to_pylist() for c in batch.columns)):
                size = tuple(map(float, detector.size(image)))
                kept = suppressed(detector.detect(image), min_confidence)
                rows += [(document, page, i, d[0], *map(float, d[1:5]), *size, float(d[5])) for i, d in enumerate(kept)]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * 7]
            names = [f.split()[0] for f in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 11, kinds)], names)

    found = pages.select(F.col("document_id").cast("string"), F.col("page_number").cast("int"), "image").mapInArrow(run, schema)
    box = bbox(*[F.col(c) for c in ("x0", "y0", "x1", "y1", "page_width", "page_height")])
    return found.select("document_id", "page_number", "region_index", region_type(F.col("class_id")).alias("region_type"), box.alias("bbox"), "detector_confidence")


def page_regions(pages: DataFrame) -> DataFrame:
    """(document_id, page_number, regions) of text pages: the regions of virtual_regions as one array a page, in
    their order. Pages without text have none, or an empty array. A page's regions come from its row."""

    def pieces(lines: Column) -> Column:
        rows = F.transform(lines, lambda x: F.greatest(F.ceil(F.length(x) / WRAP_CHARS), F.lit(1)).cast("int"))
        ends = scan(rows, "int", {"end": F.lit(0)}, lambda s, r: {"end": s["end"] + r}, "end")
        pipes = F.transform(lines, lambda x: F.contains(x, F.lit("|")))

        def of_runs(ends: Column, pipes: Column, starts: Column) -> Column:
            def piece(start: Column, after: Column, table: bool) -> Column:
                return F.struct(start.alias("start"), (after - start).alias("n"), F.coalesce(F.get(ends, start - 2), F.lit(0)).alias("top"), F.get(ends, after - 2).alias("bottom"), F.lit(table).alias("table"))

            def of_run(start: Column, k: Column) -> Column:
                after = F.coalesce(F.get(starts, k + 1), F.size(lines) + 1)
                single = F.filter(F.sequence(start, after - 1), lambda i: non_empty(F.get(lines, i - 1)))
                whole = F.get(pipes, start - 1) & (after - start >= TABLE_LINES)
                return F.when(whole, F.array(piece(start, after, True))).otherwise(F.transform(single, lambda i: piece(i, i + 1, False)))

            return F.flatten(F.transform(starts, of_run))

        return let(ends, lambda e: let(pipes, lambda p: let(run_starts(p), lambda s: of_runs(e, p, s))))

    def region(lines: Column, p: Column, index: Column) -> Column:
        y0, y1 = MARGIN + LINE_HEIGHT * p["top"], MARGIN + LINE_HEIGHT * p["bottom"]
        text = F.when(p["n"] == 1, F.get(lines, p["start"] - 1)).otherwise(F.array_join(F.slice(lines, p["start"], p["n"]), "\n"))
        return F.struct(
            index.alias("region_index"), F.when(p["table"], "table").otherwise("text").alias("region_type"), bbox(F.lit(MARGIN), y0, F.lit(PAGE_WIDTH - MARGIN), y1).alias("bbox"),
            text.alias("text"), F.lit(1.0).alias("detector_confidence"),
        )

    regions = let(F.split("native_text", "\n", -1), lambda lines: F.transform(pieces(lines), lambda p, i: region(lines, p, i)))
    return pages.select("document_id", "page_number", regions.alias("regions"))


def virtual_regions(pages: DataFrame) -> DataFrame:
    """Regions of text pages (document_id, page_number, native_text), by the geometry of their rendering:
    runs of three or more lines with a pipe are tables, every other line with text is a text region.

    One pass without a shuffle: a page is a row.
    """
    return page_regions(pages).select("document_id", "page_number", F.inline("regions"))


def widest_gap(spans: list[tuple[float, float]], least: float = GAP) -> float | None:
    """The middle of the widest gap (of ``least`` or more, the first of equals) that no span covers.

    Ends sweep in order of their coordinate, starts and ends of one span in turn. A gap counts only
    once some span has ended at a coordinate above 0.
    """
    points = sorted(((v, kind) for span in spans for v, kind in zip(span, (1, -1))), key=lambda p: p[0])
    covering, reached, best, middle = 0, 0.0, 0.0, None
    for value, kind in points:
        width = value - reached
        if covering == 0 and reached > 0 and width >= least and width > best:
            best, middle = width, (reached + value) / 2
        covering += kind
        if kind < 0:
            reached = max(reached, value)
    return middle


def reading_order(boxes: list[tuple[float, float, float, float]], least: float = GAP) -> list[int]:
    """Numbers of ``boxes`` (x0, y0, x1, y1) in reading order.

    A set is cut at its widest gap across, else at its widest gap down; a part prefers the other
    direction next. Parts that can't be cut are sorted by their centres, top to bottom, left to right.
    """
    centre = [((b[1] + b[3]) / 2, (b[0] + b[2]) / 2) for b in boxes]
    out: list[int] = []
    todo: list[tuple[list[int], int]] = [(list(range(len(boxes))), 0)]  # axis 0: cut by height, 1: by width
    while todo:
        own, preferred = todo.pop()
        for axis in (preferred, 1 - preferred) if len(own) > 1 else ():
            cut = widest_gap([(boxes[i][1 - axis], boxes[i][3 - axis]) for i in own], least)
            if cut is None:
                continue
            before = [i for i in own if centre[i][axis] <= cut]
            after = [i for i in own if centre[i][axis] > cut]
            if before and after:
                todo += [(after, 1 - axis), (before, 1 - axis)]
                break
        else:
            out += sorted(own, key=lambda i: centre[i])
    return out


def xy_cut_order(regions: DataFrame, least: float = GAP) -> DataFrame:
    """``regions`` with region_index set to the place in reading order.

    Cuts depend on the data, so they run in Python workers: pages are dealt out by key and sorted, and a
    task walks its pages as they come, holding one at a time. Only the key, the old index and the box
    travel; the order joins back by them, on the same partitioning.
    """
    names = ["document_id", "page_number", "region_index"]
    kinds = {c: regions.schema[c].dataType.simpleString() for c in names}

    def run(batches):
        import pyarrow as pa

        def orders(rows):
            places = {i: n for n, i in enumerate(reading_order([r[3:] for r in rows], least))}
            return [(*r[:3], places[i]) for i, r in enumerate(rows)]

        page: list[tuple] = []
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if page and row[:2] != page[0][:2]:
                    out += orders(page)
                    page = []
                page.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate([*(batch.schema.field(c).type for c in names), pa.int32()])], [*names, "new_index"])
            types = batch.schema
        if page:
            out = orders(page)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate([*(types.field(c).type for c in names), pa.int32()])], [*names, "new_index"])

    narrow = regions.select(*names, *[F.col(f"bbox.{c}").alias(c) for c in ("x0", "y0", "x1", "y1")])
    pages = narrow.repartition("document_id", "page_number").sortWithinPartitions(*names)
    placed = pages.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names) + ", new_index int")
    return regions.join(placed, names).drop("region_index").withColumnRenamed("new_index", "region_index").select(*regions.columns)


def crop_box(box: Column, pad: float = CROP_PAD) -> Column:
    """The region's box with a margin, within the page."""
    return F.struct(
        F.greatest(box["x0"] - pad, F.lit(0.0)).alias("x0"), F.greatest(box["y0"] - pad, F.lit(0.0)).alias("y0"),
        F.least(box["x1"] + pad, box["page_width"]).alias("x1"), F.least(box["y1"] + pad, box["page_height"]).alias("y1"),
    )


def crop_path(store: Column, document_id: Column, page: Column, index: Column, kind: Column) -> Column:
    return F.concat_ws("/", store, document_id, F.format_string("page_%03d_region_%02d_%s.png", page, index, kind))
