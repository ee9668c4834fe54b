"""starweave: a retail star-schema warehouse built from DataFrame functions.

Layout:

* ``sources``   - declared schemas, raw readers, the test-data adapter,
                  generated date series, table and view sinks;
* ``functions`` - scalar expressions (date keys, day names, exact averages);
* ``operators`` - surrogate keys, size-checked lookup joins, quality checks;
* ``plans``     - the models (staging, dimensions, calendar, fact, mart),
                  the checks, and the build/test of the whole project;
* ``llm``       - operators for training-data pipelines, on their own.

The warehouse is batch only; the staging projection is a plain ``select`` and
also works on a streaming DataFrame.
"""

__version__ = "0.1.0"
