"""corpusforge: Spark-native operators for building labelled text datasets.

Every public operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function.  Rows carry an explicit order/identity column; nothing depends on the
physical partitioning of the input.
"""

from corpusforge.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
