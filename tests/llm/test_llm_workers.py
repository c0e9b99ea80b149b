"""Functions for executors run where this package is not installed."""

import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle

from corpusflow.llm import byte_bpe, decontamination, language_cnn, main_text, maxscore, near_duplicates, phrases, runs, token_counts, toxicity
from corpusflow.workers import trimmed

SHIPPED = {
    "signatures": near_duplicates._signature_rows(4, 2, 2),
    "sets": near_duplicates._set_rows(4, np.zeros(4, np.uint64)),
    "blocks": near_duplicates._block_links(80),
    "pairs": trimmed(near_duplicates._hopeful_rows),
    "runs": trimmed(runs._run_rows(12)),
    "phrase blocks": phrases._block_rows,
    "translated": phrases._translated,
    "filters": phrases._filter_rows([3, 4], 2, np.zeros(4, np.uint64)),
    "merged": phrases._merged_rows(30),
    "items": decontamination._shingle_rows(5, None, None),
    "search": maxscore._search(3),
    "vocabulary": token_counts._vocabulary_rows([]),
    "pieces": token_counts._piece_rows("x"),
    "windows": language_cnn._window_rows,
    "language": language_cnn.Model,
    "features": toxicity._feature_rows,
    "toxicity": toxicity.Model,
    "pages": main_text._count_rows,
    "documents": token_counts._document_rows([], None),
    "encoding": byte_bpe.encoding,
}


@pytest.mark.parametrize("name", sorted(SHIPPED))
def test_no_package_needed(name, tmp_path):
    code = "import pickle, sys; pickle.load(sys.stdin.buffer); sys.exit('corpusflow' in sys.modules)"
    run = subprocess.run([sys.executable, "-I", "-c", code], input=cloudpickle.dumps(SHIPPED[name]), cwd=tmp_path, capture_output=True)
    assert run.returncode == 0, run.stderr.decode()[-500:]
