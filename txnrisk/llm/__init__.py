"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. ``queries`` holds the
registered ``opN_<name>`` queries; each operator lives in its own module and
keeps a general interface of its own."""
