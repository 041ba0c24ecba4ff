"""Declared schemas; nothing is inferred from file contents."""

from pyspark.sql import types as T

LABELLED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.IntegerType()),
    ]
)
UNLABELLED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
PROBABILITIES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("model", T.StringType()),
        T.StructField("fold", T.IntegerType()),
        T.StructField("proba", T.ArrayType(T.DoubleType())),
    ]
)
PREDICTIONS = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.IntegerType())])
RUN_RECORD = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("model_id", T.StringType()),
        T.StructField("F1-macro", T.DoubleType()),
        T.StructField("F1-macro_std", T.DoubleType()),
        T.StructField("F1-weighted", T.DoubleType()),
        T.StructField("Accuracy", T.DoubleType()),
        T.StructField("Precision-macro", T.DoubleType()),
        T.StructField("Recall-macro", T.DoubleType()),
        T.StructField("per_fold_f1", T.ArrayType(T.DoubleType())),
        T.StructField("test_dist", T.ArrayType(T.LongType())),
        T.StructField("elapsed_min", T.DoubleType()),
        T.StructField(
            "recipe",
            T.StructType(
                [
                    T.StructField("epochs", T.IntegerType()),
                    T.StructField("lr", T.DoubleType()),
                    T.StructField("label_smoothing", T.DoubleType()),
                    T.StructField("schedule", T.StringType()),
                    T.StructField("n_folds", T.IntegerType()),
                ]
            ),
        ),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)
