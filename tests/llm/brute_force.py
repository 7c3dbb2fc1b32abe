"""The test that holds each query without SQL against brute force, the library, a round trip or held-out labels."""

TESTS = {
    "op2_harmonic_packing": "test_tokens.py::test_pack_documents",
    "op3_toxic_segments": "test_models.py::test_toxicity_held_out",
    "op4_language_id": "test_models.py::test_language_held_out",
    "op5_bagminhash": "test_neardup.py::test_documents",
    "op6_weak_supervision": "test_models.py::test_quality_counts",
    "op8_bpe_transducer": "test_tokens.py::test_query_over_documents",
    "op9_url_filter": "test_models.py::test_url_query",
    "op10_weighted_sampling": "test_fingerprints.py::test_documents",
    "pipeline": "test_pipeline.py::test_stages",
}
