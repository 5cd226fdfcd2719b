"""Wordings of common licences: notices and the telling paragraphs of full texts."""

from __future__ import annotations

# The licences' own wording. A name may have several templates.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions",
    ),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2"),
    (
        "GPL",
        "under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "CC-BY-NC-4.0",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    ("CC0-1.0", "dedicated to the public domain under CC0 1.0"),
    ("MPL-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Proprietary", "All rights reserved"),
)
