"""Operations of a large-scale training-data pipeline.

One module per operator. Nothing outside this subpackage imports it; ``registry`` lists its queries.
"""
