"""seqprep: Spark-native preparation of tables whose rows hold whole sequences.

Every operator is ``DataFrame -> DataFrame`` (or ``fit -> state table``)::

    from seqprep.operators import derive, split, scale, encode, clean, corrupt, windows, evaluate

    df = derive.derive_features(derive.with_time_elapsed(workouts))
    labeled = split.temporal_split(df)                       # train / val / test per user
    train = labeled.where("split = 'train'")
    stats = scale.fit_user_stats(train, ["heart_rate", "altitude"])
    df = scale.apply_user_stats(labeled, stats, ["heart_rate", "altitude"], policy="neutral")
    noisy = corrupt.random_noise(df, ["heart_rate"], std_scale=2.0, seed=42, out_prefix="erroneous_")
    cleaned = clean.fit_transform(df)                        # fit bounds, clean
    scored = windows.predict_inline(cleaned, evaluate.lagged_mean_scorer, ["altitude"], "heart_rate",
                                    heartrate_input_column="heart_rate")
    evaluate.metrics(scored).show()

Subpackages: ``functions`` (column and SQL-expression builders), ``sources``
(schemas, readers/writers, test fixtures), ``operators``, ``plans``
(state tables, exact ranks and quantiles, composed flows), ``streaming``.
"""
