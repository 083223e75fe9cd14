"""Named inputs, snapshot outputs and the shared work folder."""
