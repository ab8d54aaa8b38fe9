"""The model DAG (staging -> intermediate -> marts) and the dataset loaders."""
