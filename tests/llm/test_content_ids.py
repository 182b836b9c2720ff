"""Texts whose polynomial hashes modulo 2**64 are equal keep their own cuts."""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from tidewater.llm import common, suffix
from tidewater.llm import textkernel as K


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_clashing_texts_are_told_apart(spark):
    common.ship_package(spark)
    one = thue_morse(1024)
    two = one.translate(str.maketrans("ab", "ba"))
    ids = suffix._content_ids(next(K.chunks(pa.array([one, two, one, "", None]))))
    assert ids[0] != ids[1] and ids[0] == ids[2] and ids[3] == ids[4]
    # one passage is shared with another text, the other is not
    tail = "".join(chr(33 + (i * i + 7 * i) % 90) for i in range(260))
    rows = [(1, one + tail), (2, two), (3, tail + "z"), (4, two + "q")]
    found = {r.doc_id: r for r in suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("h", F.sha2("kept", 256)).collect()}
    texts = dict(rows)
    starts = {}
    for d, t in rows:
        for i in range(len(t) - 199):
            starts[t[i : i + 200]] = starts.get(t[i : i + 200], 0) + 1
    for d, t in texts.items():
        gone = [any(starts.get(t[i : i + 200], 0) > 1 for i in range(max(0, k - 199), min(k, len(t) - 200) + 1)) for k in range(len(t))]
        kept = "".join(c for c, g in zip(t, gone) if not g)
        assert found[d].n_removed == sum(gone) and found[d].h == hashlib.sha256(kept.encode()).hexdigest()
