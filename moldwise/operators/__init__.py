"""DataFrame operators, one module per family.

features   long -> wide daily features, vertical features, sensor means, daily scrap
joins      date / machine key standardisation, production x feature joins, join report
windows    lags, rolling means, scoring context, time split, label codes, planning KPIs
quality    data-quality checks returning issue DataFrames, validation reports
summaries  profiles of readings, feature tables and ML datasets
selection  feature selection rules, numeric coercion, median fill, risk label
splits     deterministic group / row / stratified splits and split reports
metrics    regression and classification metrics, confusion matrix, naive baseline
models     Spark ML training, importance, cross-validation, forecasting
quantiles  exact quantiles by distributed rank narrowing (approximate opt-in)
ranking    global row numbers and label code tables
"""
