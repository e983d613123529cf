"""Image preparation: shorter side to 256, centre crop 224, scale to [0, 1], standardise."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from modelpulse.functions.scalar import CHANNEL_MEAN, CHANNEL_STD

# Target sizes of the preparation.
RESIZE_TO = 256
CROP_TO = 224

TENSOR_SCHEMA = T.StructType(
    [T.StructField("origin", T.StringType()), T.StructField("tensor", T.ArrayType(T.FloatType()))]
)


@lru_cache(maxsize=256)
def resample_weights(size_in: int, size_out: int):
    """Triangle-filter weights [out, in]; the filter widens when shrinking, so nothing is skipped."""
    import numpy as np

    scale = size_in / size_out
    reach = max(scale, 1.0)
    centres = (np.arange(size_out) + 0.5) * scale
    distance = np.abs(np.arange(size_in)[None, :] + 0.5 - centres[:, None]) / reach
    weights = np.clip(1.0 - distance, 0.0, None)
    return weights / weights.sum(axis=1, keepdims=True)


def prepare(pixels):
    """float32 [3, 224, 224] from uint8 [height, width, 3] in red-green-blue order.

    Only what the crop keeps is resampled, and the byte values that come of it are standardised by a table.
    """
    import numpy as np

    height, width = pixels.shape[:2]
    short = min(height, width)
    new_h, new_w = int(RESIZE_TO * height / short), int(RESIZE_TO * width / short)
    top, left = round((new_h - CROP_TO) / 2), round((new_w - CROP_TO) / 2)
    across, down = resample_weights(width, new_w)[left : left + CROP_TO], resample_weights(height, new_h)[top : top + CROP_TO]
    planes = pixels.transpose(2, 0, 1).astype(np.float64)
    wide = np.rint(planes @ across.T)
    both = np.rint(down @ wide).astype(np.int64)
    # The weights of a pixel are positive and add up to one, so what comes of bytes are bytes.
    return np.stack([table[plane] for table, plane in zip(_standardised(), both)])


@lru_cache(maxsize=1)
def _standardised():
    """Per channel the standardised float32 of every byte value."""
    import numpy as np

    scaled = np.arange(256)[:, None] / 255.0
    return ((scaled - np.array(CHANNEL_MEAN)) / np.array(CHANNEL_STD)).T.astype(np.float32)


def to_rgb(row):
    """Red-green-blue pixels of a decoded image row; grey is repeated, transparency dropped."""
    import numpy as np

    flat = np.frombuffer(row.data, dtype=np.uint8).reshape(row.height, row.width, row.nChannels)
    if row.nChannels == 1:
        return np.repeat(flat, 3, axis=2)
    return flat[:, :, 2::-1]


def image_tensors(images: DataFrame, rows_per_batch: int = 8, then: Callable | None = None, schema: T.StructType | str = TENSOR_SCHEMA) -> DataFrame:
    """One tensor per decoded image; small output batches keep the worker's memory flat.

    ``then`` (a model, ``checksum_batches``) takes the Arrow batches of tensors where they are made and gives such of ``schema``.
    A tensor is thousands of times its image: to hand it over as a row costs more than to make it.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for held in batches:
            for start in range(0, held.num_rows, rows_per_batch):
                part = held.slice(start, rows_per_batch)
                values = np.stack([prepare(to_rgb(row)).ravel() for row in part.to_pandas().itertuples(index=False)])
                offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
                yield pa.RecordBatch.from_arrays([part.column("origin"), pa.ListArray.from_arrays(offsets, values.ravel())], ["origin", "tensor"])

    chained = run if then is None else lambda batches: then(run(batches))
    return images.select("origin", "height", "width", "nChannels", "data").mapInArrow(chained, schema)


CHECKSUM_SCHEMA = "origin string, red bigint, green bigint, blue bigint, lowest float, highest float"


def checksum_batches(batches, modulus: int = 9973):
    """Arrow batches (origin, one whole number per channel, range) of batches (origin, tensor)."""
    import numpy as np
    import pyarrow as pa

    # Sums of whole numbers far below 2**53, so floating point is exact.
    place = 1.0 + np.arange(CROP_TO**2) % modulus
    std, mean = np.array(CHANNEL_STD)[:, None], np.array(CHANNEL_MEAN)[:, None]
    kinds = [pa.string(), *[pa.int64()] * 3, *[pa.float32()] * 2]
    for held in batches:
        rows = []
        for i, origin in enumerate(held.column("origin").to_pylist()):
            values = np.asarray(held.column("tensor")[i].values, dtype=np.float32)
            channels = values.reshape(3, -1) * std
            channels += mean
            channels *= 255
            rows.append((origin, *(np.rint(channels, out=channels) @ place).astype(np.int64).tolist(), values.min(), values.max()))
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else [()] * len(kinds), kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["origin", "red", "green", "blue", "lowest", "highest"])


def channel_checksums(tensors: DataFrame, modulus: int = 9973) -> DataFrame:
    """``origin``, one whole number per channel that weighs each of its byte values by its place, and the range of the tensor."""
    return tensors.select("origin", "tensor").mapInArrow(lambda batches: checksum_batches(batches, modulus), CHECKSUM_SCHEMA)
