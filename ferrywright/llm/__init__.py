"""Operators that prepare training corpora: thirteen first-class jobs and the pipeline that chains five of them."""
