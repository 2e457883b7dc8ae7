"""The Jaccard join keeps no intermediate folder longer than its successor reads it."""

from __future__ import annotations

from pathlib import Path
from urllib.parse import urlparse

from quotelake.llm import jaccard


def test_folders_go_with_the_step_that_reads_them(spark, monkeypatch):
    texts = [" ".join(f"w{(k // 4) * 50 + n}" for n in range(40)) + f" x{k}" for k in range(40)]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    root = Path(urlparse(spark.conf.get("spark.checkpoint.dir")).path, "quotelake")
    before = {p.name for p in root.glob("*")}
    present = {}

    def staged(rows, purpose, stage=jaccard.staged):
        present[purpose] = {p.name.rsplit("-", 1)[0] for p in root.glob("*") if p.name not in before}
        return stage(rows, purpose)

    monkeypatch.setattr(jaccard, "staged", staged)
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(documents).collect()}
    assert found == {k: k // 4 * 4 for k in range(40)}
    assert not present["jaccard-prefixes"] & {"jaccard-sets"}
    assert not present["jaccard-tokens"] & {"jaccard-sets", "jaccard-classes"}
    assert not present["jaccard-posts"] & {"jaccard-sets", "jaccard-classes", "jaccard-prefixes", "jaccard-whole"}
    assert not present["jaccard-first"] & {"jaccard-tokens"}
