"""Language ID rejects what is in no learnt language."""

import random

import numpy as np
from pyspark.sql import functions as F

from gleanspark.llm import langid

UNLEARNT = ["日本語のテキストは学習されていない言語です。今日は天気がとても良いですね。", "Это предложение написано на русском языке, которого нет в модели.", "Bu cümle Türkçe yazılmıştır ve modelde yoktur çünkü öğretilmedi.",
            "Tämä lause on kirjoitettu suomeksi, eikä malli ole nähnyt sitä kieltä koskaan aikaisemmin missään."]


def test_unlearnt_languages_and_random_letters_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    clean = langid.fold(F.col("doc_id"), 5) == 0
    model = langid.train(docs.where(~clean))
    rng = random.Random(1)
    texts = UNLEARNT + ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (200, 1000)]
    texts += [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 7))) for _ in range(n)) for n in (20, 300)]
    odd = langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert len(model.labels) == 4 and all(r["rejected"] for r in odd)
    held = langid.predict(docs.where(clean), model).agg(F.count("*"), F.sum(F.col("rejected").cast("int"))).first()
    assert held[1] <= 0.002 * held[0]


def test_small_samples_do_not_set_the_bound(monkeypatch):
    model = langid.Model(["a", "b"], np.array([[3.0, 0.0, 1.0], [0.0, 3.0, 1.0]]), np.zeros(2), 1.0, 0.0)
    held = [(0, "ab"[k % 2], np.array([k % 2]), np.array([1])) for k in range(10)]
    assert langid._calibrated(model, held, {"a": 0, "b": 1}).reject_below <= langid.REJECT_CHANCE / 2
