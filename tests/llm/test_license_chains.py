"""A licence broken by long insertions is one chain; whole copies stay apart."""

import pytest

from sparloom.llm import license_scan
from sparloom.llm.license_templates import TEMPLATES


@pytest.mark.parametrize("parts", [3, 5])
@pytest.mark.parametrize("foreign", [10, 300])
def test_broken_licence_is_found(spark, parts, foreign):
    words = TEMPLATES["mit"].split()
    cut = [len(words) * k // parts for k in range(parts + 1)]
    noise = [" ".join(f"foreign{k}x{n}" for n in range(foreign)) for k in range(parts)]
    text = " ".join(f"{' '.join(words[a:b])} {noise[k]}" for k, (a, b) in enumerate(zip(cut, cut[1:])))
    rows = [(1, text), (2, TEMPLATES["mit"] + " between " + TEMPLATES["mit"]), (3, " ".join(words[: len(words) // 3]))]
    got = [r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id int, text string")).collect() if r.license == "mit"]
    one = [r for r in got if r.id == 1]
    assert len(one) == 1 and one[0].coverage == 1 and len(one[0].spans) == parts
    assert (one[0].first_word, one[0].last_word) == (one[0].spans[0].first_word, one[0].spans[-1].last_word)
    assert [(r.coverage, len(r.spans)) for r in got if r.id == 2] == [(1, 1)] * 2 and not [r for r in got if r.id == 3]
