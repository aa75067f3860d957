"""Table operators: profiling, statistics, imputation, encoding, alignment,
splits and metrics.  Fitted operators follow ``fit(train) -> Fitted`` and
``Fitted.transform(df) -> DataFrame`` (a single ``select``)."""
