"""mailspark: a PySpark-native text-classification engine for labelled mail.

Every operator is ``DataFrame -> DataFrame`` or ``Column -> Column``; the
sub-packages are

* ``functions``  - Column expressions: cleaning, tokens, stemming, stopwords
* ``operators``  - DataFrame operators: counts, vocabulary, weights, split,
  model, evaluation, tuning
* ``sources``    - readers and writers: mail folders, driver tables, model
  tables, prediction / report sinks
* ``plans``      - the end-to-end jobs: tuning, hold-out quality, final
  training, batch scoring
* ``streaming``  - Structured Streaming scoring
"""

from mailspark.config import VectorizerConfig, tfidf_preset

__all__ = ["VectorizerConfig", "tfidf_preset"]
