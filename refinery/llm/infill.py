r"""Fill-in-the-middle documents as a pipeline of Arrow kernels.

A text is cut into lines (``[^\n]*\n|[^\n]+``); two hashed cut points among
them give prefix, middle and suffix, which come out as ``<P>prefix<S>suffix
<M>middle`` (form ``psm``), as ``<S>suffix<P>prefix<M>middle`` (``spm``), or
unchanged (``plain``).  Per batch: the texts are split into lists of units,
flattened with the index of their parent, numbered within it, filtered by
role, put back into lists, and each list is joined; no Python loop runs over
rows or units.

Plan on Spark: one pass without a shuffle; the cuts depend on the id alone,
so a retried task writes the same rows.  A task holds batches of about
``BATCH_BYTES`` of text, or one row.

Defined cases: a null text counts as empty; an empty text has no units and is
``plain``, as is one that holds a sentinel (it could not be read back); the
id null hashes like an empty one; repeated rows and ids are each transformed;
a very long text is one batch of its own; an empty table gives no rows; other
columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.scratch import parts, ship

SENTINELS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM = "7", 100, 50


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The lines of all texts as one array, the text and the place in it of
    each, and the number of lines of each text."""
    lists = pc.split_pattern(texts, "\n")
    parent = pc.list_parent_indices(lists).to_numpy()
    sizes = pc.list_value_length(lists).to_numpy()
    ends = np.cumsum(sizes)
    pieces = pc.list_flatten(lists)
    ordinal = np.arange(len(parent)) - (ends - sizes)[parent]
    # What follows the last line end of a text is a unit only if it holds something.
    last = pa.array(ordinal == sizes[parent] - 1)
    whole = pc.binary_join_element_wise(pieces, pc.if_else(last, "", "\n"), "")
    real = pc.not_equal(whole, "")
    n = sizes - pc.invert(real.take(pa.array(ends - 1))).to_numpy(zero_copy_only=False)
    kept = real.to_numpy(zero_copy_only=False)
    return whole.filter(real), parent[kept], ordinal[kept], n.astype(np.int64)


def _joined(whole: pa.Array, parent: np.ndarray, role: np.ndarray, rows: int) -> pa.Array:
    """The units of one role, joined per text."""
    counts = np.bincount(parent[role], minlength=rows)
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, whole.filter(pa.array(role))), "")


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = SEED, rate: int = RATE, spm: int = SPM,
                   sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``doc_id``, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars``
    (code points; null if plain) and ``output`` of every row.  ``rate`` per
    cent of the texts are transformed, ``spm`` per cent of these in that form.
    Cut points and choices are the first four 32-bit words of the SHA-256 of
    ``seed:doc_id``."""
    ship(docs.sparkSession)
    p, s, m = sentinels
    kind = docs.schema[doc_id].dataType.simpleString()
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    words = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]

    def run(batches):
        for batch in parts(batches, 1):
            texts = pc.fill_null(batch.column(1), "")
            h1, h2, h3, h4 = (batch.column(2 + k).to_numpy() for k in range(4))
            whole, parent, ordinal, n = units(texts)
            cuts = h1 % (n + 1), h2 % (n + 1)
            low, high = np.minimum(*cuts)[parent], np.maximum(*cuts)[parent]
            roles = ordinal < low, (ordinal >= low) & (ordinal < high), ordinal >= high
            prefix, middle, suffix = (_joined(whole, parent, role, len(texts)) for role in roles)
            plain = pc.or_(pc.equal(texts, ""), pa.array(h3 % 100 >= rate))
            for mark in sentinels:
                plain = pc.or_(plain, pc.match_substring(texts, mark))
            turned = pa.array(h4 % 100 < spm)
            built = pc.if_else(turned, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, ""),
                               pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, ""))
            none = pa.scalar(None, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pc.if_else(plain, "plain", pc.if_else(turned, "spm", "psm")),
                 pc.if_else(plain, none, pc.utf8_length(prefix).cast(pa.int64())), pc.if_else(plain, none, pc.utf8_length(middle).cast(pa.int64())),
                 pc.if_else(plain, texts, built)], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select(F.col(doc_id), F.col(text), *words).mapInArrow(run, schema)


def restore(transformed: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``transformed`` with ``restored``, the exact text read back from
    ``output`` and ``form`` alone."""
    part = F.split("output", "|".join(re.escape(x) for x in sentinels), -1)  # '', then the three pieces in their order
    text = (F.when(F.col("form") == "psm", F.concat(part[1], part[3], part[2]))
            .when(F.col("form") == "spm", F.concat(part[2], part[3], part[1])).otherwise(F.col("output")))
    return transformed.withColumn("restored", text)


def op11_infill(spark, sf_dir):
    found = restore(fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


OP11_SQL = r"""
with cut as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u,
         sha256('7:' || cast(doc_id as varchar)) as h from documents),
drawn as (
  select doc_id, t, u, len(u) as n, cast('0x' || substr(h, 1, 8) as bigint) % (len(u) + 1) as a,
         cast('0x' || substr(h, 9, 8) as bigint) % (len(u) + 1) as b, cast('0x' || substr(h, 25, 8) as bigint) % 100 as d from cut),
roles as (
  select doc_id, t, n, array_to_string(u[1:least(a, b)], '') as p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as m,
         array_to_string(u[greatest(a, b) + 1:], '') as s,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') then 'plain'
              when d < 50 then 'spm' else 'psm' end as form from drawn)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from roles
"""
