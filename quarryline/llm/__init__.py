"""Operators for text collections that train or test language models. Nothing outside this subpackage imports it."""
