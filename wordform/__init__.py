"""wordform: a Spark-native engine for German derivative corpora.

Stages (``wordform.plans.stages``): filter_comments, find_derivatives,
merge_months, productivity, make_corpora. Operators live in
``wordform.operators``, Column functions in ``wordform.functions``, readers in
``wordform.sources``, writers in ``wordform.sinks``.
"""

import os

DATA_DIR = os.path.join(os.path.dirname(__file__), "data")
# The affix lists that results must be made with, one per line.
PREFIX_FILE = os.path.join(DATA_DIR, "prefixes.txt")
SUFFIX_FILE = os.path.join(DATA_DIR, "suffixes.txt")
