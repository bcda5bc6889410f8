"""The field of personal data against counts over all texts."""

import numpy as np

from stratamart.llm import personal_data


def test_every_document_is_counted(spark, docs):
    texts = [f"Call +49 30 {1000000 + i} or {1000000 + i}, mail a{i}@b.org" for i in range(2_200)] + ["Id 123456789", None]
    found = personal_data.trained(spark.createDataFrame([(i or None, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    unary, chain, equal, other = (sum(x) for x in zip(*(personal_data.evidence(t or "") for t in texts)))
    assert unary.sum() > 4_400, "addresses and numbers of all texts"
    expected = personal_data._counted(unary, chain, int(equal), int(other))
    assert np.allclose(found.unary, expected.unary) and np.allclose(found.chain, expected.chain) and np.isclose(found.skip, expected.skip)
