"""Operators for building text training corpora on Spark. Nothing outside this
subpackage imports it; ``registry`` holds the queries that apply them."""
