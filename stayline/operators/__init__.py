"""DataFrame -> DataFrame operators, by topic.

cleaning   event filters, attribute filling, the clean log
users      per-user aggregates and derived features
agents     user agents and their families
labels     churn labels and id sets
encoding   one-hot columns and alignment
ranking    distributed running totals and exact quantiles
splitting  stratified split, folds, class weights
metrics    ROC AUC, PR curve, confusion counts, run records
summaries  exploratory counts, medians, box plots
drift      two-sample Kolmogorov-Smirnov
imbalance  nearest neighbours and synthetic minority rows
"""
