"""The hook that runs a caller's model over a text column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_type

# Fixed value: rows per model call.
CALL_ROWS = 100


def apply_model(
    rows: DataFrame,
    text: str,
    model: Callable[[list[str]], list],
    value: str,
    value_type: T.DataType,
    call_rows: int = CALL_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """``rows`` without ``text``, plus the model's ``value`` and an ``error``.

    The model maps a list of texts to a list of values and is called on at most ``call_rows`` of them. If a
    call fails its rows are tried one by one; a row that still fails gets a NULL value and the error, and so
    stays in the queue. Arrow batches go through unconverted but for the text column. With ``tasks`` the
    queue is dealt out evenly first, which pays when a call costs more than moving its texts.
    """
    kept = [f for f in rows.schema.fields if f.name != text]
    schema = T.StructType(kept + [T.StructField(value, value_type), T.StructField("error", T.StringType())])
    arrow_value = to_arrow_type(value_type)
    kept_names = [f.name for f in kept]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def alone(item):
            try:
                return model([item])[0], None
            except Exception as failure:
                return None, f"{type(failure).__name__}: {failure}"

        for batch in batches:
            for start in range(0, batch.num_rows, call_rows):
                part = batch.slice(start, call_rows)
                texts = part.column(text).to_pylist()
                try:
                    results = [(r, None) for r in model(texts)]
                    if len(results) != len(texts):
                        raise ValueError("the model must return one value per text")
                except Exception:
                    results = [alone(item) for item in texts]
                columns = [part.column(name) for name in kept_names]
                columns.append(pa.array([r for r, _ in results], arrow_value))
                columns.append(pa.array([e for _, e in results], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=kept_names + [value, "error"])

    queue = rows.select(*kept_names, text)
    return (queue.repartition(tasks) if tasks else queue).mapInArrow(run, schema)
