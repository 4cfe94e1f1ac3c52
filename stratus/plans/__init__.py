"""Composite models (staging -> dims -> link -> facts -> marts) and the registered queries."""
