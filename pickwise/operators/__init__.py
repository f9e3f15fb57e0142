"""DataFrame -> DataFrame operators. Long form is the working shape."""
