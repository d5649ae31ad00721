"""DataFrame -> DataFrame operators. See SURVEY-style IDs in each module docstring."""
