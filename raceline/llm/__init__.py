"""Operators for preparing language-model training data. One module per
operator; ``queries`` registers one ``opN_<name>`` query for each."""
