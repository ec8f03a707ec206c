"""Operators for training corpora. Nothing else in the package uses them."""

from pyspark import cloudpickle

from . import align, audit, chat, common, decontamination, embeddings, licences, lines, merkle, mixing, secrets, simhash, tokens, toxicity, xxh64
from .common import CHECKS, QUERIES

# Tasks get these functions by value, so executors need no copy of the package.
for _module in (align, audit, common, chat, embeddings, simhash, tokens, toxicity, xxh64):
    cloudpickle.register_pickle_by_value(_module)
