"""fieldcraft: click/conversion feature engineering, encoding, scoring and
evaluation expressed as Spark DataFrame jobs.

Every public operator is a plain function ``op(df, ...) -> DataFrame`` built
from native Spark expressions. Sub-packages:

* ``sources``   - driver-table fixtures and file formats (CSV, profile text,
                  FFM text, score files)
* ``functions`` - column-level helpers (tokenising, digitize, digamma,
                  ordered prefix sums)
* ``operators`` - joins, counts, target statistics, ordered features,
                  encoders, information scores, models, ensembles, embeddings
* ``plans``     - the registered queries and their SQL oracles
* ``llm``       - training-data operators over documents, pages and
                  conversations; nothing else imports it
"""

__version__ = "0.1.0"
