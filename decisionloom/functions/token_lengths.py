"""Token lengths of whole texts by a tokenizer's file: an Arrow function, with lengths kept by word."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # so that executors need no copy of this package

#: Words whose lengths a worker keeps; beyond it starts anew.
KEPT = 300_000


def with_token_lengths(docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens", apart: bool = True) -> DataFrame:
    """docs + name: tokens of the text without special ones, a null text has none.

    apart: the tokenizer drops white space and treats what stands between it alone, so lengths can be kept by word; otherwise each
    text is encoded as a whole.
    """

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        own, known = Tokenizer.from_file(path), {}
        sizes = lambda texts: [len(e.ids) for e in own.encode_batch_fast(texts, add_special_tokens=False)]
        at = None
        for batch in batches:
            at = batch.schema.get_field_index("_text") if at is None else at
            texts = [x or "" for x in batch.column(at).to_pylist()]
            if apart:
                words = [t.split() for t in texts]
                new = list({w for ws in words for w in ws if w not in known})
                if len(known) + len(new) > KEPT:
                    known.clear()
                    new = list({w for ws in words for w in ws})
                known.update(zip(new, sizes(new), strict=True))
                n = [sum(map(known.__getitem__, ws)) for ws in words]
            else:
                n = sizes(texts)
            yield pa.RecordBatch.from_arrays([*[c for i, c in enumerate(batch.columns) if i != at], pa.array(n, pa.int64())], names=[*[x for i, x in enumerate(batch.schema.names) if i != at], name])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select(*rest, F.col(text).alias("_text")).mapInArrow(run, f"{kinds}, {name} long")
