"""Fitted-model persistence (the reference saves and reloads its models by
path).  The keyword stage needs no MLlib model: the vocabulary and idf are a
table (``Stores.vocabulary``), read like any other input."""

from __future__ import annotations

from pyspark.ml.feature import Word2VecModel
from pyspark.ml.recommendation import ALSModel


def load_word2vec(path: str) -> Word2VecModel:
    return Word2VecModel.load(path)


def load_als(path: str) -> ALSModel:
    return ALSModel.load(path)
